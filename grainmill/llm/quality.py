"""Quality rules whose thresholds come from the data: one mergeable quantile sketch per language, source and measure.

The sketch is a histogram of integer measures with logarithmic bins: every power of two is cut into 16, so a bin is narrower
than 1/16 of its values. Sketches merge by adding counts, in any order and with the same result, so Spark builds them with
partial aggregation and a hot source never meets in one task. A rule rejects a value above

    upper quartile + SPREAD * max(upper quartile - median, FLOOR)

of its own (language, source), or of its language where the pair has fewer than MIN_ROWS texts. A group in which everybody
has many symbols therefore accepts many symbols; the floor keeps a group of equal texts from rejecting a small difference.

Defined results: null text is the empty text (no words, base rule fails); null language or source is a group of its own; an
empty table gives no rows and no thresholds; repeated rows count as often as they occur; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import SEPARATORS, bind, stored, words

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIN_ROWS = 50
SPREAD = 4
BIN_BITS = 4
#: Least spread of each measure, all in thousandths: symbols per word, repeated lines per line, repeated words per word,
#: capital letters per letter, letters per word.
FLOORS = {"symbol_rate": 50, "line_rate": 60, "repeat_rate": 50, "capital_rate": 100, "word_length": 2500}
SALTS = 16


def repeated_words(text_words: Column) -> Column:
    """Words that lie in a five-word window found twice or more in the array.

    Windows are told apart by 64 bits. The few texts with a repeat sort their windows; the length of the union of the
    repeated ones is added up from the distances between their starts.
    """

    def marked(keys: Column) -> Column:
        order = F.sort_array(F.transform(keys, lambda k, i: F.struct(k.alias("k"), i.alias("i"))))

        def starts(s: Column) -> Column:
            twin = lambda x, j: (
                F.coalesce(F.get(s, j - 1)["k"] == x["k"], F.lit(False))
                | F.coalesce(F.get(s, j + 1)["k"] == x["k"], F.lit(False))
            )
            return F.sort_array(F.transform(F.filter(s, twin), lambda x: x["i"]))

        covered = lambda p: F.aggregate(
            F.transform(p, lambda x, j: F.least(F.coalesce(F.get(p, j + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))),
            F.lit(0).cast("long"),
            lambda a, x: a + x,
        )
        return bind(bind(order, starts), covered)

    def windows(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])
        )

    counted = bind(
        bind(F.transform(text_words, lambda x: F.xxhash64(x)), windows),
        lambda keys: F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0).cast("long")).otherwise(marked(keys)),
    )
    return F.when(F.size(text_words) < WINDOW + 1, F.lit(0).cast("long")).otherwise(counted)


def measures(docs: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id, lang, source, the counts of every whole text, whether it fails the base rule, and the rates in thousandths.

    ``carry`` adds the row itself as one struct ``row``.
    """
    text = F.coalesce("text", F.lit(""))
    own = ["row"] if carry else []
    docs = docs.withColumn("row", F.struct(*docs.columns)) if carry else docs
    row = docs.select(*own, "doc_id", "lang", "source", words("text").alias("w"), text.alias("t"))
    row = row.select(
        *own, "doc_id", "lang", "source",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.translate("t", SEPARATORS, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _lines("t").alias("l"),
        repeated_words(F.col("w")).alias("n_repeat_words"),
        F.length(F.regexp_replace("t", "[^\\p{Lu}]+", "")).cast("long").alias("n_capitals"),
    )
    rate = lambda part, whole: F.coalesce(F.floor(1000 * F.col(part) / F.nullif(F.col(whole), F.lit(0))), F.lit(0))
    return row.select(
        *own, "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols",
        F.col("l.again").alias("n_dup_lines"), "n_repeat_words",
        ((F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))).alias("base_failed"),
        rate("n_symbols", "n_words").alias("symbol_rate"),
        rate("l.again", "l.all").alias("line_rate"),
        rate("n_repeat_words", "n_words").alias("repeat_rate"),
        rate("n_capitals", "word_chars").alias("capital_rate"),
        rate("word_chars", "n_words").alias("word_length"),
    )


def _lines(text: str) -> Column:
    """Lines with a word, and how many of them equal an earlier one."""
    full = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SEPARATORS, "") != "")
    return bind(
        full,
        lambda x: F.struct(
            F.size(x).cast("long").alias("all"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("again")
        ),
    )


def sketch_bin(value: Column) -> Column:
    """Least value of the bin that a whole number lies in."""
    shift = F.greatest(F.length(F.bin(value)) - (BIN_BITS + 1), F.lit(0))
    step = F.pow(F.lit(2.0), shift).cast("long")
    return (value - value % step).cast("long")


def sketches(rows: DataFrame, group: list[str], names: list[str]) -> DataFrame:
    """One row per group, measure and filled bin: the sketch as a table; sketches merge by adding ``n``."""
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), sketch_bin(F.col(m)).alias("bin")) for m in names])
    return rows.select(*group, F.inline(pairs)).groupBy(*group, "measure", "bin").agg(F.count(F.lit(1)).alias("n"))


def quantiles(sketch: DataFrame, group: list[str], at: dict[str, float]) -> DataFrame:
    """Quantiles of every group and measure, read off the sketch: the first bin whose running count reaches the share."""
    whole = Window.partitionBy(*group, "measure")
    ranked = sketch.withColumns({"upto": F.sum("n").over(whole.orderBy("bin")), "of": F.sum("n").over(whole)})
    picks = [F.min(F.when(F.col("upto") >= share * F.col("of"), F.col("bin"))).alias(name) for name, share in at.items()]
    return ranked.groupBy(*group, "measure").agg(*picks, F.max("of").alias("n_rows"))


def thresholds(rows: DataFrame, names: list[str]) -> DataFrame:
    """Per language and source: the limit of every measure as one column each."""
    at = {"mid": 0.5, "high": 0.75}
    fine = sketches(rows, ["lang", "source"], names)
    coarse = fine.groupBy("lang", "measure", "bin").agg(F.sum("n").alias("n"))
    own = quantiles(fine, ["lang", "source"], at)
    shared = quantiles(coarse, ["lang"], at).select(
        F.col("lang").alias("g_lang"), F.col("measure").alias("g_measure"), F.col("mid").alias("g_mid"), F.col("high").alias("g_high")
    )
    both = own.join(shared, F.col("lang").eqNullSafe(F.col("g_lang")) & (F.col("measure") == F.col("g_measure")))
    floor = F.element_at(F.create_map(*[F.lit(x) for kv in FLOORS.items() for x in kv]), F.col("measure"))
    pick = lambda a, b: F.when(F.col("n_rows") >= MIN_ROWS, F.col(a)).otherwise(F.col(b))
    mid, high = pick("mid", "g_mid"), pick("high", "g_high")
    limit = high + SPREAD * F.greatest(high - mid, floor)
    return both.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("measure") == m, limit)).alias(f"{m}_limit") for m in names]
    )


def judge(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """Rows of ``measures`` with the limits of their group and ``kept``.

    Limits are repeated for each salt, so the rows of a hot source meet them in many tasks.
    """
    names = list(FLOORS)
    limits = limits.select(
        F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), *[f"{m}_limit" for m in names],
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("t_salt"),
    )
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int"))
    same = (
        F.col("lang").eqNullSafe(F.col("t_lang"))
        & F.col("source").eqNullSafe(F.col("t_source"))
        & (F.col("salt") == F.col("t_salt"))
    )
    inside = F.lit(True)
    for m in names:
        inside = inside & (F.col(m) <= F.col(f"{m}_limit"))
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(True))
    return salted.join(limits, same, "left").withColumn("kept", kept).drop("salt", "t_lang", "t_source", "t_salt")


def quality_rules(docs: DataFrame) -> DataFrame:
    """One row per document: counts, limits and verdict. Texts are read once; the counts are kept in the shared folder."""
    rows = stored(measures(docs), "quality")
    return judge(rows, thresholds(rows, list(FLOORS)))


def good_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep. Texts are measured for the limits and again for the verdict, and not shuffled."""
    limits = stored(thresholds(measures(docs), list(FLOORS)), "limits")
    return judge(measures(docs, carry=True), limits).where("kept").select("row.*")
