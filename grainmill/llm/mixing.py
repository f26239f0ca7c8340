"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Targets. Sources in code point order (null last) weigh 5, 2, 1, 5, 2, 1, ... and share all words. A target stops at REPEATS
times its source's size, and the excess is shared again by weight. With sources sorted by REPEATS * size / weight this has a
closed form: the first k sources stop, the others take ``weight * (total - stopped) / weight left``.

Quotas. The words are cut into blocks of ``block_words``. Blocks go to the highest quotients target / 1, target / 3,
target / 5 ... Those above a safe divisor are counted by rounding; only the last few seats, at most two per party, are ranked.
Each source's blocks are then apportioned in the same way to its shards (documents split by a keyed digest, about
``shard_words`` words each), so a source of any size is spread over many tasks.

Selection. Inside a shard the documents stand in the order of a keyed digest, and its n blocks receive q copies: block j gets
floor((j + 1 + r) q / n) - floor((j + r) q / n) of them, r from the key. No block gets more than REPEATS copies.

Documents without words are left out of the order, so a source of empty texts fills no shard. Texts of one id, source and size are told
apart by their digests; exact copies with one id stand in one shard.

Defined results: null text has size 0; null source is one source; repeated doc_ids are separate documents; an empty table gives
no rows; sources without words have target 0. The table of sources, one row each, is ordered in one task: weights are given by
source, so it is a list that people keep.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import bind, stored, words

WEIGHTS = (5, 2, 1)
REPEATS = 3
BLOCK_WORDS = 16
SHARD_WORDS = 1_000_000
KEY = "mix-1"
SALTS = 16


def source_targets(sizes: DataFrame) -> DataFrame:
    """source, source_size and target of every source; ``sizes`` has source and size."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    nth = (F.row_number().over(order) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (nth + 1).cast("int")).cast("long")
    ranked = totals.withColumn("weight", weight).withColumn("full_at", REPEATS * F.col("source_size") / F.col("weight"))
    up = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    everything = up.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    run = ranked.select(
        "source", "source_size", "weight", "full_at", F.row_number().over(up).alias("nth"),
        (F.sum("source_size").over(everything) - REPEATS * F.coalesce(F.sum("source_size").over(before), zero)).alias("left_words"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), zero)).alias("left_weight"),
    )
    # The first source that the rest can be shared from without stopping it; all before it stop.
    fits = F.col("left_words") / F.col("left_weight") <= F.col("full_at")
    run = run.withColumn("from", F.min(F.when(fits, F.struct("nth", "left_words", "left_weight"))).over(everything))
    share = F.col("weight") * F.col("from.left_words") / F.col("from.left_weight").cast("double")
    stop = (REPEATS * F.col("source_size")).cast("double")
    target = F.when(F.col("nth") < F.coalesce(F.col("from.nth"), F.col("nth") + 1), stop).otherwise(share)
    return run.select("source", "source_size", target.alias("target"))


def apportion(parties: DataFrame, seats: Column, claim: Column, most: Column, group: list[str], key: list[Column]) -> DataFrame:
    """Adds ``quota``: of ``seats`` in each group, what each party gets by the highest quotients claim / (2k + 1).

    ``most`` is the largest quota of a party. At a divisor of total / (seats - parties / 2) rounding gives too few seats, at
    total / (seats + parties / 2) too many, and between them lie at most two quotients per party on average; those are ranked.
    """
    whole = Window.partitionBy(*group)
    frame = parties.withColumns({"_seats": seats, "_claim": claim.cast("double"), "_most": most.cast("long")})
    frame = frame.withColumns({"_total": F.sum("_claim").over(whole), "_parties": F.count(F.lit(1)).over(whole)})
    rounded = lambda s: F.floor(F.col("_claim") * s / F.nullif(F.col("_total"), F.lit(0.0)) + 0.5).cast("long")
    low = F.greatest(F.coalesce(rounded(F.greatest(F.col("_seats") - F.col("_parties") / 2 - 1, F.lit(0.0))), F.lit(0)), F.lit(0))
    high = F.coalesce(rounded(F.col("_seats") + F.col("_parties") / 2 + 1), F.lit(0))
    frame = frame.withColumns({"_low": F.when(F.col("_claim") > 0, low).otherwise(0).cast("long"), "_high": high.cast("long")})
    frame = frame.withColumn("_open", F.greatest(F.col("_seats") - F.sum("_low").over(whole), F.lit(0)))
    claims = frame.withColumn(
        "_quotient",
        F.explode_outer(
            F.when(
                F.col("_high") > F.col("_low"),
                F.transform(F.sequence("_low", F.col("_high") - 1), lambda k: F.col("_claim") / (2 * k + 1)),
            )
        ),
    )
    best = Window.partitionBy(*group).orderBy(F.col("_quotient").desc_nulls_last(), *key)
    won = (F.col("_quotient").isNotNull() & (F.row_number().over(best) <= F.col("_open"))).cast("long")
    columns = parties.columns
    claims = claims.withColumn("_won", won)
    quota = F.least(F.max("_low") + F.sum("_won"), F.max("_most")).alias("quota")
    return claims.groupBy(*columns).agg(quota)


def mixed(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, key: str = KEY) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, and where the document's words lie in its shard.

    ``start`` is the place of its first word, ``copies`` and ``blocks`` are the q and n of the shard, ``turn`` its r; ``content`` is the
    digest of the text.
    """
    # Documents without an id are told apart by their texts, so that they are spread over the shards too.
    content = _content()
    ident = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.col("text").cast("binary")), F.lit(""))
    digest = F.md5(F.concat_ws("/", F.lit(key), ident).cast("binary"))
    sizes = docs.select("doc_id", "source", F.size(words("text")).cast("long").alias("size"), digest.alias("digest"), content.alias("content"))
    sizes = stored(sizes, "mixing")
    sources = source_targets(sizes)
    shards_of = F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1))
    sources = apportion(
        sources.withColumns({"n_shards": shards_of.cast("long"), "one": F.lit(1)}),
        F.floor(F.sum("source_size").over(Window.partitionBy("one")) / block_words + 0.5),
        F.col("target"), F.col("target") * 0 + 2**62, ["one"], [F.col("source").asc_nulls_last()],
    ).drop("one")
    number = F.conv(F.substring("digest", 1, 8), 16, 10).cast("long")
    about = sources.select(
        F.col("source").alias("s_source"), "source_size", "target", "n_shards", F.col("quota").alias("source_quota"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("s_salt"),
    )
    placed = (
        sizes.withColumns({"salt": F.pmod(number, F.lit(SALTS)).cast("int")})
        .join(about, F.col("source").eqNullSafe(F.col("s_source")) & (F.col("salt") == F.col("s_salt")))
        .withColumn("shard", F.pmod(number, F.col("n_shards")))
        .drop("s_source", "s_salt", "salt", "n_shards")
    )
    ordered = placed.where("size > 0")
    shards = ordered.groupBy("source", "shard").agg(
        F.sum("size").alias("shard_size"), F.max("source_quota").alias("source_quota"), F.max("target").alias("source_target")
    )
    shards = shards.withColumn("blocks", F.ceil(F.col("shard_size") / block_words).cast("long"))
    shards = apportion(
        shards, F.col("source_quota"), F.col("shard_size"), REPEATS * F.col("blocks"), ["source"], [F.col("shard").asc()]
    )
    turn = F.conv(F.substring(F.md5(F.concat_ws("/", F.lit(key), F.lit("turn"), F.coalesce("source", F.lit("")), F.col("shard").cast("string"))), 1, 7), 16, 10)
    shards = shards.select(
        F.col("source").alias("h_source"), F.col("shard").alias("h_shard"), "blocks", F.col("quota").alias("copies"),
        F.when(F.col("blocks") > 0, turn.cast("long") % F.col("blocks")).otherwise(0).alias("turn"),
    )
    line = Window.partitionBy("source", "shard").orderBy("digest", "doc_id", "size", "content")
    ordered = ordered.withColumn("start", F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    ordered = ordered.join(shards, F.col("source").eqNullSafe(F.col("h_source")) & (F.col("shard") == F.col("h_shard")))
    taken = _upto(F.col("start") + F.col("size"), block_words) - _upto(F.col("start"), block_words)
    about = ["doc_id", "source", "size", "source_size", "target"]
    ordered = ordered.select(*about, taken.cast("long").alias("taken"), "start", "blocks", "copies", "turn", "content")
    nothing = [F.lit(0).cast("long").alias(c) for c in ("taken", "start", "blocks", "copies", "turn")]
    return ordered.unionByName(placed.where("size = 0").select(*about, *nothing, "content"))


def _content() -> Column:
    return F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))


def block_copies(block: Column) -> Column:
    """Copies that a block of the shard gets."""
    return _seats(block + 1) - _seats(block)


def _seats(block: Column) -> Column:
    blocks = F.nullif(F.col("blocks"), F.lit(0))
    return F.floor((block + F.col("turn")) * F.col("copies") / blocks).cast("long") - F.floor(F.col("turn") * F.col("copies") / blocks).cast("long")


def _upto(word: Column, block_words: int) -> Column:
    """Words taken before a place in the shard."""
    block = F.floor(word / block_words).cast("long")
    return block_words * _seats(block) + (word - block * block_words) * block_copies(block)


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as documents: each text holds the words taken from it, block by block, repeated as often as they are taken.

    Documents of which nothing is taken go. Rows with the same doc_id, source and text are told apart by their order. size,
    source_size, target and taken are added, in place of columns of these names; n_chars, where there is one, is counted anew.
    """
    key = F.sha2(F.to_json(F.struct("doc_id", "source", "size", F.hex("content").alias("content"))), 256)
    alike = Window.partitionBy("k")
    plan = mixed(docs, block_words).where("taken > 0").withColumn("k", key)
    plan = plan.withColumn("m_nth", F.row_number().over(alike.orderBy("start"))).select(
        F.col("k").alias("m_k"), "m_nth", "source_size", "target", "taken", "start", "blocks", "copies", "turn"
    )
    own = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "source", F.size(words("text")).cast("long").alias("size"), _content().alias("content"))
    own = own.select("row", "size", key.alias("k")).withColumn("nth", F.row_number().over(alike.orderBy("row.text")))
    # Both sides are dealt by k alone, so the texts are moved once, for their order and for the join.
    both = own.join(plan, (F.col("k") == F.col("m_k")) & (F.col("nth") - F.col("m_nth") == 0))
    first, last = F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)

    def piece(w: Column, block: Column) -> Column:
        begin = F.greatest(block * block_words - F.col("start"), F.lit(0))
        end = F.least((block + 1) * block_words - F.col("start"), F.col("size"))
        part = F.slice(w, (begin + 1).cast("int"), (end - begin).cast("int"))
        return F.flatten(F.array_repeat(part, block_copies(block).cast("int")))

    # The words are bound, as a lambda would split the text again for every block.
    taken = bind(words(F.col("row.text")), lambda w: F.flatten(F.transform(F.sequence(first, last), lambda block: piece(w, block))))
    both = both.withColumn("mixed", F.array_join(taken, " "))
    made = {"text": F.col("mixed"), "n_chars": F.length("mixed").cast("long")}
    about = ["size", "source_size", "target", "taken"]
    kept = [made.get(c, F.col("row")[c]).alias(c) for c in docs.columns if c not in about]
    return both.select(*kept, *about)

