"""Near-duplicates by BagMinHash: signatures of weighted five-word shingles, bands, and an exact check of the multisets.

A shingle that occurs w times has weight w. Weights are cut into the levels [0, 1), [1, 2), [2, 4), [4, 8) ... Each (shingle, level) has a
Poisson process of its own, with a rate as large as the level is long; its points carry a time, a register and a height, and
points above the weight are passed over. A register keeps the earliest point. Two texts keep the same point with a probability equal
to their weighted Jaccard similarity. A process stops when its time passes the latest register, so heavy weights cost their logarithm.

1. Texts of equal words are one node (its smallest doc_id). Nodes get 128 registers, in 32 bands of 4: at a similarity of 0.8 two
   nodes share no band with a chance of 5e-8.
2. Every bucket has a hub, the member whose buckets are the fullest: in a group of copies this is the one most like the others. Every node is
   checked against the hub it shares most buckets with, on the whole multisets: one pair per node.
3. Links give components. In buckets that still hold several of them, all pairs across components whose registers agree on at least
   LEAST_AGREE (0.8 less 4.5 standard errors) are checked inside the bucket, each pair in the first bucket it shares, and only links come
   out. Buckets of more than LARGE nodes are first split by each of the other bands, so no group has to fit into a task.

No pair within a component is ever needed, so copies cost one pair each, and pairs that are no link are never written anywhere. Multisets are
kept as 32 bits per shingle and occurrence; two texts of 1,000 words then have a chance match with a probability of 2e-4.

Defined results: texts without words are classes of their own; texts of one to four words have one shingle, the whole text; rows that
share a doc_id are one document; rows with a null doc_id get a null class; an empty table gives no rows; doc_id is an integer.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.sizing import broadcast_if_small
from . import rolling
from .common import stored
from .components import components

SHINGLE = 5
REGISTERS = 128
BANDS = 32
SIMILARITY = 0.8
LEAST_AGREE = 0.64
LARGE = 2000
PIECE_BYTES = 4 << 20
_STEP, _LEVEL, _REGISTER, _HEIGHT = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))


def shingles(words: rolling.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, value and weight of every distinct shingle, in the order of texts; and a value for each whole text."""
    counts = np.diff(words.offsets)
    texts = np.arange(len(counts))
    doc = np.repeat(texts, counts)
    place = np.arange(len(doc)) - np.repeat(words.offsets[:-1], counts)
    whole = np.zeros(len(counts), np.uint64)
    if len(doc):
        powers = rolling.powers(rolling.WORD_BASES[1], int(counts.max()) + 1)[1:]
        run = np.r_[np.uint64(0), np.cumsum(words.values * powers[place])]
        whole = rolling.mix(run[words.offsets[1:]] - run[words.offsets[:-1]] + counts.astype(np.uint64))
    inside = words.inside(SHINGLE)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    doc = np.r_[doc[inside], short]
    value = np.r_[words.windows(SHINGLE)[inside], whole[short]]
    key = rolling.mix(value + doc.astype(np.uint64) * _STEP)
    _, at, weight = np.unique(key, return_index=True, return_counts=True)
    order = np.argsort(doc[at], kind="stable")
    return doc[at][order], value[at][order], weight[order], whole


def signatures(doc: np.ndarray, value: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Registers of n texts from their shingles: 32 bits of the earliest point, 0 where a text has none."""
    levels = np.where(weight == 1, 1, np.ceil(np.log2(np.maximum(weight, 2))).astype(np.int64) + 1)
    cell = np.repeat(np.arange(len(doc)), levels)
    level = np.arange(len(cell)) - np.repeat(np.cumsum(levels) - levels, levels)
    d, w = doc[cell], weight[cell]
    low = np.where(level == 0, 0, 2.0 ** (level - 1))
    length = np.maximum(low, 1.0)
    seed = rolling.mix(value[cell] + level.astype(np.uint64) * _LEVEL)
    time = np.zeros(len(cell))
    first, kept = np.full(n * REGISTERS, np.inf), np.zeros(n * REGISTERS, np.uint32)
    step = np.zeros(1, np.uint64)
    while len(d):
        step += _STEP
        point = rolling.mix(seed + step)
        time = time - np.log(((point >> np.uint64(11)).astype(float) + 1) * 2.0**-53) / length
        register = d * REGISTERS + (rolling.mix(point ^ _REGISTER) % np.uint64(REGISTERS)).astype(np.int64)
        height = low + np.floor((rolling.mix(point ^ _HEIGHT) >> np.uint64(11)).astype(float) * 2.0**-53 * length)
        better = np.flatnonzero((height < w) & (time < first[register]))
        np.minimum.at(first, register[better], time[better])
        won = better[first[register[better]] == time[better]]
        kept[register[won]] = (point[won] >> np.uint64(32)).astype(np.uint32)
        going = time < first.reshape(n, REGISTERS).max(axis=1)[d]
        if not going.all():
            d, w, low, length, seed, time = (x[going] for x in (d, w, low, length, seed, time))
    return kept.reshape(n, REGISTERS)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for begin, end in rolling.pieces(texts, PIECE_BYTES):
            words = rolling.words(texts[begin:end])
            doc, value, weight, whole = shingles(words)
            n = end - begin
            registers = signatures(doc, value, weight, n)
            counts = np.diff(words.offsets)
            other = np.bincount(np.repeat(np.arange(n), counts), (words.values >> np.uint64(40)).astype(float), n).astype(np.uint64)
            content = np.stack([whole, rolling.mix(other + counts.astype(np.uint64) * _STEP)], 1)
            keep = counts > 0
            packed = lambda rows, keep=keep: pa.array([r.tobytes() if k else None for r, k in zip(rows, keep, strict=True)], pa.binary())
            ids = batch.column("doc_id").slice(begin, n).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([ids, packed(content), packed(registers)], ["doc_id", "content", "registers"])


def _multisets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted values of (shingle, 1st, 2nd ... occurrence) of each text: the overlap of two multisets is that of two sets."""
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        for begin, end in rolling.pieces(texts, PIECE_BYTES):
            doc, value, weight, _ = shingles(rolling.words(texts[begin:end]))
            nth = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
            value = rolling.mix(np.repeat(value, weight) + nth.astype(np.uint64) * _LEVEL)
            doc = np.repeat(doc, weight)
            order = np.lexsort((value, doc))
            value = value[order]
            cuts = np.searchsorted(doc[order], np.arange(end - begin + 1))
            sets = pa.array([np.sort(value[a:b].astype(np.uint32)).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("node").slice(begin, end - begin), sets], ["node", "bag"])


def alike(x: bytes, y: bytes) -> bool:
    """Whether two packed multisets overlap by at least SIMILARITY."""
    if min(len(x), len(y)) < SIMILARITY * max(len(x), len(y)):
        return False
    a, b = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
    both = int(rolling.found(a, b).sum())
    return both >= SIMILARITY * (len(a) + len(b) - both) - 1e-9


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose multisets overlap enough."""
    for batch in batches:
        keep = [alike(x, y) for x, y in zip(batch.column("bag_a").to_pylist(), batch.column("bag_b").to_pylist(), strict=True)]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def bags_of(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """node and packed multiset of the documents in ``nodes``; their list is broadcast where it measures small."""
    wanted, _ = broadcast_if_small(nodes.select(F.col("node").alias("doc_id")))
    rows = docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi")
    bags = rows.select(F.col("doc_id").cast("long").alias("node"), "text").mapInArrow(_multisets, "node long, bag binary")
    return bags.where("octet_length(bag) > 0")


def checked_links(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes that are alike. A node in many pairs is split by the adaptive skew join."""
    rows = pairs.join(bags.select(F.col("node").alias("b"), F.col("bag").alias("bag_b")), "b")
    rows = rows.join(bags.select(F.col("node").alias("a"), F.col("bag").alias("bag_a")), "a")
    return rows.select("a", "b", "bag_a", "bag_b").mapInArrow(_checked, "a long, b long").distinct()


class Bucket:
    """Members of a bucket, and for each one the later members of other components that may be alike."""

    def __init__(self, table: pa.Table):
        self.table = table.sort_by("node")
        self.node, self.label = self.table["node"].to_numpy(), self.table["label"].to_numpy()
        self.band = self.table["band"][0].as_py()
        self.registers = np.frombuffer(b"".join(self.table["registers"].to_pylist()), np.uint32).reshape(-1, REGISTERS)

    def candidates(self) -> Iterator[tuple[int, np.ndarray]]:
        for i in range(len(self.node) - 1):
            other = np.flatnonzero((self.label[i + 1 :] != self.label[i]) & (self.node[i + 1 :] != self.node[i])) + i + 1
            if len(other):
                same = self.registers[other] == self.registers[i]
                share = same.mean(axis=1)
                near = share >= LEAST_AGREE
                if near.any():
                    # A pair that shares an earlier band was looked at there; split buckets (band -1) look at all.
                    whole = same[near].reshape(-1, BANDS, REGISTERS // BANDS).all(axis=2)
                    first = ~whole[:, : max(self.band, 0)].any(axis=1)
                    yield i, other[near][first][np.argsort(-share[near][first], kind="stable")]


def _with_candidates(table: pa.Table) -> pa.Table:
    """Members of a bucket that are in some candidate pair."""
    bucket = Bucket(table)
    used = np.zeros(len(bucket.node), bool)
    for i, others in bucket.candidates():
        used[others] = True
        used[i] |= len(others) > 0
    return bucket.table.select(["bucket", "band", "node", "label"]).filter(pa.array(used))


def _cross_links(table: pa.Table) -> pa.Table:
    """Links across components of a bucket; pairs that earlier links have joined are not looked at."""
    bucket = Bucket(table)
    bags = bucket.table["bag"].to_pylist()
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while x in parent:
            x = parent[x]
        return x

    links = []
    for i, others in bucket.candidates():
        for j in others.tolist():
            p, q = root(int(bucket.label[i])), root(int(bucket.label[j]))
            if p != q and alike(bags[i], bags[j]):
                parent[max(p, q)] = min(p, q)
                links.append((int(bucket.node[i]), int(bucket.node[j])))
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def _band_values(registers: str) -> Column:
    """A value for each band of the packed registers."""
    width = 4 * REGISTERS // BANDS
    return F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(k, F.substr(F.col(registers), k * width + 1, F.lit(width)))
    )


def unsettled(buckets: DataFrame, labels: DataFrame, nodes: DataFrame, large: int = LARGE) -> DataFrame:
    """Members (bucket, band, node, label) of buckets with several components; parts of large ones have band -1.

    A large bucket is split by each of the other bands: a pair that shares one band shares another with the same near-certainty. What is
    still large is dealt into blocks, and every two blocks meet, so no task gets more than two blocks.
    """

    def mixed(rows: DataFrame) -> DataFrame:
        groups = rows.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("n"))
        return stored(rows.join(groups.where("lo <> hi").select("bucket", "n"), "bucket"), "unsettled")

    columns = ["bucket", "band", "node", "label"]
    rows = mixed(buckets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node")))
    finer = rows.where(F.col("n") > large).join(nodes.select("node", "bands"), "node").select("*", F.explode("bands").alias("other"))
    finer = mixed(finer.select(F.xxhash64("bucket", "other").alias("bucket"), F.lit(-1).alias("band"), "node", "label"))
    blocks = F.ceil(F.col("n") / large)
    block = F.pmod(F.xxhash64("node"), blocks)
    met = finer.where(F.col("n") > large).select("*", block.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)).alias("with"))
    met = met.withColumn("bucket", F.xxhash64("bucket", F.least("own", "with"), F.greatest("own", "with")))
    parts = [rows.where(F.col("n") <= large), finer.where(F.col("n") <= large), met]
    return reduce(DataFrame.unionByName, [p.select(*columns) for p in parts])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id and class_id (the smallest doc_id of its class) of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    signed = docs.select("doc_id", "text").mapInArrow(_signed, "doc_id long, content binary, registers binary")
    signed = stored(signed, "signatures")
    known = signed.where("doc_id is not null and content is not null")
    owner = stored(known.groupBy("content").agg(F.min("doc_id").alias("node")), "nodes")
    nodes = known.join(owner, (known.doc_id == owner.node) & (known.content == owner.content), "left_semi")
    nodes = nodes.select(F.col("doc_id").alias("node"), "registers", _band_values("registers").alias("bands"))
    banded = nodes.select("node", F.posexplode("bands").alias("band", "bucket")).distinct()
    full = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stored(banded.join(full, "bucket"), "buckets")
    rank = members.groupBy("node").agg(F.sum("n").alias("rank"))
    best = F.struct("rank", (-F.col("node")).alias("m"), "node")
    hubs = members.join(rank, "node").groupBy("bucket").agg(F.max(best)["node"].alias("hub"))
    shared = members.join(hubs, "bucket").where("hub <> node").groupBy("node", "hub").agg(F.count(F.lit(1)).alias("n"))
    pairs = shared.groupBy("node").agg(F.max(F.struct("n", (-F.col("hub")).alias("m"), "hub"))["hub"].alias("a"))
    bags = stored(bags_of(members.select("node").distinct(), docs), "bags")
    links = stored(checked_links(pairs.select("a", F.col("node").alias("b")), bags), "links")
    labels = components(links)
    layout = "bucket long, band int, node long, label long"
    open_rows = unsettled(members.select("bucket", "band", "node"), labels, nodes)
    signs = nodes.select("node", "registers")
    near = open_rows.join(signs, "node").select("bucket", "band", "node", "label", "registers").groupBy("bucket").applyInArrow(_with_candidates, layout)
    near = stored(near, "candidates").join(signs, "node").join(bags, "node").select("bucket", "band", "node", "label", "registers", "bag")
    found = stored(near.groupBy("bucket").applyInArrow(_cross_links, "a long, b long").distinct(), "links")
    if not found.isEmpty():
        labels = components(links.union(found))
    classes = owner.join(labels, "node", "left").select("content", F.coalesce("label", "node").alias("class_id"))
    placed = signed.select("doc_id", "content").join(classes, "content", "left")
    of_its_own = F.col("content").isNull() | F.col("doc_id").isNull()
    placed = placed.select("doc_id", F.when(of_its_own, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))
    return placed.select(F.col("doc_id").cast(kind), F.col("class_id").cast(kind))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each class the row with the smallest doc_id (null last).

    Rows are numbered and told apart by that, so different texts with one doc_id stay and copies without a doc_id go.
    """
    rows = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    classes = near_duplicates(rows.select(F.col("_row").alias("doc_id"), "text"))
    placed = rows.select("_row", "doc_id").join(classes.select(F.col("doc_id").alias("_row"), "class_id"), "_row")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row"))["_row"].alias("_row")
    return rows.join(placed.groupBy("class_id").agg(first).select("_row"), "_row", "left_semi").select(*docs.columns)
