"""Address lookup: find the range that contains an address and attach its location; of nested or overlapping ranges the shortest one.

Ranges are cut at /16 boundaries. In a bucket whose ranges overlap, the pieces are swept once more: between two neighbouring bounds the
same ranges are open, and the shortest of them is found among the aligned blocks around the lower bound, 17 at most, however many ranges
lie inside each other. For a dictionary whose measured size allows it, whole /16 and whole /24 blocks are looked up by their
prefix and the rest is cut at /28, so an address meets at most 16 pieces however dense the dictionary is; all three are broadcast and the
hits are not moved. A larger dictionary is resolved on the distinct addresses with one window per /16 bucket; a bucket holds at
most 65,536 addresses and as many range starts, whatever the data looks like.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.location import UNKNOWN_AREA, UNKNOWN_COUNTRY, area_of, city_of, province_of
from ..functions.scalars import ip_number
from ..session import written
from .sizing import broadcast_if_small, is_small

# Rows of one address that a single task still joins easily.
HOT_ROWS = 4_000_000


BUCKET_BITS = 16


def range_pieces(ranges: DataFrame) -> DataFrame:
    """Disjoint pieces of the ranges inside /16 buckets.

    Where ranges overlap, the shortest one wins; of equally long ones the later one, then the first by its texts.
    """
    bucket = F.explode(
        F.sequence(F.shiftright("begin_ip", BUCKET_BITS), F.shiftright("end_ip", BUCKET_BITS))
    ).alias("bucket")
    start = F.shiftleft("bucket", BUCKET_BITS)
    pieces = ranges.where("begin_ip <= end_ip").select("*", bucket).select(
        "bucket",
        F.greatest("begin_ip", start).alias("low"),
        F.least("end_ip", start + F.lit((1 << BUCKET_BITS) - 1)).alias("high"),
        F.struct((F.col("end_ip") - F.col("begin_ip")).alias("length"), (-F.col("begin_ip")).alias("later"), "country", "area").alias("r"),
    )
    before = Window.partitionBy("bucket").orderBy("low").rowsBetween(Window.unboundedPreceding, -1)
    meets = F.coalesce(F.max("high").over(before) >= F.col("low"), F.lit(False))
    marked = pieces.withColumn("meets", meets).withColumn("tangled", F.max("meets").over(Window.partitionBy("bucket")))
    texts = ["bucket", "low", "high", F.col("r.country").alias("country"), F.col("r.area").alias("area")]
    single = marked.where("not tangled").select(*texts)
    return single.unionByName(_swept(marked.where("tangled").select("bucket", "low", "high", "r")).select(*texts))


def _aligned_blocks(low: Column, high: Column) -> Column:
    """The fewest aligned blocks (bits, prefix) that make up the addresses low .. high of a bucket, two of each size at most."""
    start = F.struct(low.alias("a"), (high + 1).alias("b"), F.array().cast("array<struct<bits:int,prefix:bigint>>").alias("out"))

    def step(acc: Column, bits: Column) -> Column:
        # Bounds in units of this size; an odd one gives a block of it, the rest goes on in units twice as large.
        left = (F.pmod(acc["a"], F.lit(2)) == 1) & (acc["a"] < acc["b"])
        after = acc["a"] + F.when(left, 1).otherwise(0)
        right = (F.pmod(acc["b"], F.lit(2)) == 1) & (after < acc["b"])
        until = acc["b"] - F.when(right, 1).otherwise(0)
        block = lambda prefix: F.array(F.struct(bits.cast("int").alias("bits"), prefix.alias("prefix")))
        none = F.array().cast("array<struct<bits:int,prefix:bigint>>")
        found = F.concat(acc["out"], F.when(left, block(acc["a"])).otherwise(none), F.when(right, block(until)).otherwise(none))
        return F.struct(F.shiftright(after + 1, 1).alias("a"), F.shiftright(until, 1).alias("b"), found.alias("out"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(BUCKET_BITS)), start, step, lambda acc: acc["out"])


def _swept(pieces: DataFrame) -> DataFrame:
    """Pieces between neighbouring bounds of the overlapping ranges of each bucket, each with the shortest range open there."""
    blocks = pieces.select("r", F.explode(_aligned_blocks(F.col("low"), F.col("high"))).alias("block"))
    blocks = blocks.groupBy("block.bits", "block.prefix").agg(F.min("r").alias("r"))
    bounds = pieces.select("bucket", F.explode(F.array("low", F.col("high") + 1)).alias("low")).distinct()
    following = F.lead("low").over(Window.partitionBy("bucket").orderBy("low"))
    gaps = bounds.withColumn("high", following - 1).where("high is not null")
    around = gaps.select("*", F.explode(F.sequence(F.lit(0), F.lit(BUCKET_BITS))).alias("bits"))
    around = around.withColumn("prefix", F.expr("shiftright(low, bits)"))
    return around.join(blocks, ["bits", "prefix"]).groupBy("bucket", "low", "high").agg(F.min("r").alias("r"))


def _unknown_texts() -> dict[str, Column]:
    return {"country": F.lit(UNKNOWN_COUNTRY), "area": F.lit(UNKNOWN_AREA)}


def _known(df: DataFrame, unknown: dict[str, Column]) -> DataFrame:
    """The location columns, with fixed values where no range matched."""
    miss = F.col("low").isNull()
    return df.withColumns({c: F.when(miss, v).otherwise(F.col(c)) for c, v in unknown.items()})


#: Prefix lengths of the lookup: bits left of an address, coarse to fine.
CUTS = (16, 8, 4)


def prefix_pieces(pieces: DataFrame) -> DataFrame:
    """Pieces by (cut, prefix): whole /16 blocks, whole /24 blocks inside the others, and the rest cut at /28."""

    def cut_at(df: DataFrame, bits: int) -> DataFrame:
        blocks = df.select("*", F.explode(F.sequence(F.shiftright("low", bits), F.shiftright("high", bits))).alias("prefix"))
        start = F.shiftleft("prefix", bits)
        bounds = {"low": F.greatest("low", start), "high": F.least("high", start + F.lit((1 << bits) - 1))}
        return blocks.withColumns(bounds)

    out, rest = None, pieces.drop("bucket")
    for bits in CUTS:
        blocks = cut_at(rest, bits)
        whole = F.col("high") - F.col("low") == (1 << bits) - 1
        mine = blocks if bits == CUTS[-1] else blocks.where(whole)
        mine = mine.withColumn("cut", F.lit(bits))
        out = mine if out is None else out.unionByName(mine)
        rest = blocks.where(~whole).drop("prefix")
    return out


def locate_by_broadcast(
    df: DataFrame, pieces: DataFrame, ip: str = "ip", unknown: dict[str, Column] | None = None
) -> DataFrame:
    """Left lookup by prefix and bounds; adds the location columns of the pieces of ``prefix_pieces``."""
    unknown = unknown or _unknown_texts()
    joined = df.withColumn("ip_num", ip_number(ip))
    for bits in CUTS:
        names = {"prefix": f"p{bits}", "low": f"low{bits}", "high": f"high{bits}"} | {c: f"{c}{bits}" for c in unknown}
        side = F.broadcast(pieces.where(F.col("cut") == bits).select(*[F.col(c).alias(n) for c, n in names.items()]))
        inside = F.shiftright("ip_num", bits) == F.col(f"p{bits}")
        if bits == CUTS[-1]:
            inside = inside & (F.col("ip_num") >= F.col(f"low{bits}")) & (F.col("ip_num") <= F.col(f"high{bits}"))
        joined = joined.join(side, inside, "left")
    low = F.coalesce(*[F.col(f"low{b}") for b in CUTS]).alias("low")
    # The block that matched decides, also where its text is null.
    texts = []
    for c in unknown:
        value = F.when(F.col(f"low{CUTS[0]}").isNotNull(), F.col(f"{c}{CUTS[0]}"))
        for b in CUTS[1:]:
            value = value.when(F.col(f"low{b}").isNotNull(), F.col(f"{c}{b}"))
        texts.append(value.alias(c))
    return _known(joined.select(*df.columns, low, *texts), unknown).drop("low")


def locate_by_window(
    df: DataFrame,
    pieces: DataFrame,
    ip: str = "ip",
    unknown: dict[str, Column] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The same result where the dictionary is too large to broadcast.

    Distinct addresses are located with a window and joined back. Addresses with very many rows are
    joined by broadcast instead (there is at most one per ``hot_rows`` rows), and their rows, like
    rows without a valid address, get spread-out keys in the shuffle join, where nothing matches.
    """
    number = ip_number(ip)
    counts = df.where(number.isNotNull()).groupBy(F.col(ip).alias("ip_text"))
    counts = counts.agg(F.count(F.lit(1)).alias("n")).withColumn("at", ip_number("ip_text"))
    points = counts.select(F.shiftright("at", 16).alias("bucket"), "at", "ip_text", "n")
    unknown = unknown or _unknown_texts()
    piece = F.struct("low", "high", *unknown).alias("piece")
    starts = pieces.select("bucket", F.col("low").alias("at"), piece)
    stacked = points.unionByName(starts, allowMissingColumns=True)
    # At an equal position the range start comes first.
    order = Window.partitionBy("bucket").orderBy("at", F.col("ip_text").isNotNull())
    order = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = stacked.withColumn("piece", F.last("piece", ignorenulls=True).over(order))
    found = found.where(F.col("ip_text").isNotNull() & (F.col("at") <= F.col("piece.high")))
    located = found.select("ip_text", "n", "piece")
    hot = located.where(F.col("n") >= hot_rows).select(
        F.col("ip_text").alias(ip), F.col("piece").alias("hot_piece")
    )
    spread = F.concat(
        F.lit("#"), F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(65536)).cast("string")
    )
    hot, _ = broadcast_if_small(hot)
    left = df.join(hot, ip, "left").withColumn(
        "ip_key",
        F.when(F.col("hot_piece").isNotNull() | number.isNull(), spread).otherwise(F.col(ip)),
    )
    cold = located.where(F.col("n") < hot_rows).select(F.col("ip_text").alias("ip_key"), "piece")
    joined = left.join(cold, "ip_key", "left").withColumn("piece", F.coalesce("hot_piece", "piece"))
    joined = joined.select(*df.columns, *[f"piece.{c}" for c in ("low", *unknown)])
    return _known(joined, unknown).drop("low")


def _locate(df: DataFrame, pieces: DataFrame, ip: str, unknown: dict[str, Column]) -> DataFrame:
    # Taken apart once: its size and the three broadcasts are read from what was written.
    cut = written(prefix_pieces(pieces), "address-pieces")
    if is_small(cut):
        return locate_by_broadcast(df, cut, ip, unknown)
    return locate_by_window(df, pieces, ip, unknown)


def locate(df: DataFrame, ranges: DataFrame, ip: str = "ip") -> DataFrame:
    """Add ``country`` and ``area`` text of the range that holds the address."""
    return _locate(df, range_pieces(ranges), ip, _unknown_texts())


def with_location(df: DataFrame, ranges: DataFrame, ip: str = "ip") -> DataFrame:
    """Add province, city and area as the cleaned streams carry them.

    The location texts are taken apart in the dictionary, not once per hit.
    """
    parts = {"province": province_of, "city": city_of}
    pieces = range_pieces(ranges)
    pieces = pieces.select(
        "bucket", "low", "high", *[f("country").alias(c) for c, f in parts.items()], area_of("area").alias("area")
    )
    unknown = {c: f(F.lit(UNKNOWN_COUNTRY)) for c, f in parts.items()}
    return _locate(df, pieces, ip, unknown | {"area": area_of(F.lit(UNKNOWN_AREA))})


def find_ranges(ranges: DataFrame, text: str) -> DataFrame:
    """Ranges whose country or area text contains a fragment."""
    return ranges.where(F.col("country").contains(text) | F.col("area").contains(text))


def hits_in_ranges(ranges: DataFrame, hits: DataFrame, ip: str = "ip") -> DataFrame:
    """begin_ip, end_ip and ``hit_count`` of every range, 0 included; equal addresses are counted before they meet a range."""
    per_ip = hits.groupBy(ip_number(ip).alias("n")).agg(F.count(F.lit(1)).alias("c"))
    buckets = F.explode(F.sequence(F.shiftright("begin_ip", 16), F.shiftright("end_ip", 16)))
    spread = ranges.select("begin_ip", "end_ip", buckets.alias("bucket"))
    inside = (F.col("bucket") == F.shiftright("n", 16)) & F.col("n").between(F.col("begin_ip"), F.col("end_ip"))
    found = spread.join(per_ip, inside, "left").groupBy("begin_ip", "end_ip")
    return found.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("hit_count"))
