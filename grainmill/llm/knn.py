"""Exact top-k search by inner product: a Voronoi kNN join.

Pivots are rows picked by a hash of their content. Every row belongs to the cell of its nearest pivot, and in it to a ring, by its
distance from the pivot in half powers of two. The summary of a ring holds its number of rows, largest distance r and largest norm. For
a query q and a row x of a ring around pivot p, q.x <= q.p + |q| r and q.x <= |q| |x|, and q.x >= q.p - |q| r. So the summaries bound
from above what a ring can hold for a query, and from below its k-th best score; real scores against a bounded set of rows raise the
lower bound. A query is sent only to rings that may hold a row at or above its lower bound. Unlike with a distance, where a query's
own cell lies does not enter the bound, so each query is bounded by itself, which is never looser than a bound for all queries of its cell.

Rows and queries of a ring are dealt into blocks of a fixed size by row number, so a vector that a third of all rows share is spread like
any other; a block of rows meets a block of queries in one task, as matrices, and keeps k rows per query. The partial results are cut
to k per query before their shuffle. Only pivots, probes and ring summaries come to the driver; parameters bound all three.

Scores are exact: products of integers below 2^53 in doubles, larger ones in 64-bit integers (which wrap, as in SQL without checks).

Defined results: vectors that are null or hold null, NaN or infinite components take no part; missing components of a shorter vector
count as 0 (an empty vector scores 0 everywhere); rows that share the query's id are its own; a row repeated under another id counts each
time; of several vectors under one query id the smallest one asks; rows without id can be found (null sorts last) but do not ask; ties go
to the smaller id; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored

SCALE = 1024
K = 10
PIVOTS = 64
PROBES = 1024
RINGS = 256
BLOCK_ROWS = 16384
BLOCK_QUERIES = 2048
EXACT = float(2**53)
NO_ID = np.iinfo(np.int64).max


def scaled(vector: Column | str, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component as long; null for a vector that takes no part."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(whole, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double"))))


def matrix(vectors: pa.Array, width: int = 0) -> np.ndarray:
    """One row per vector, filled with 0 up to the longest one or ``width``."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    length = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    width = max([width, *length[:1], *([int(length.max())] if len(length) else [])])
    if len(length) and (length == width).all():
        return values.reshape(len(length), width)
    out = np.zeros((len(length), width), np.int64)
    row = np.repeat(np.arange(len(length)), length)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(length) - length, length)] = values
    return out


def widened(rows: np.ndarray, width: int) -> np.ndarray:
    return rows if rows.shape[1] >= width else np.pad(rows, ((0, 0), (0, width - rows.shape[1])))


def norms(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows.astype(float) ** 2).sum(axis=1))


def scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """All inner products, exactly."""
    width = max(queries.shape[1], rows.shape[1])
    queries, rows = widened(queries, width), widened(rows, width)
    most = norms(queries).max(initial=0) * norms(rows).max(initial=0)
    if most < EXACT / 2:
        return (queries.astype(float) @ rows.astype(float).T).astype(np.int64)
    return queries @ rows.T


def best_of(score: np.ndarray, ids: np.ndarray, k: int, least: int) -> np.ndarray:
    """Positions of the k highest scores that reach ``least``, best first, ties to smaller ids."""
    at = np.flatnonzero(score >= least)
    if len(at) > k:
        kth = np.partition(score[at], len(at) - k)[len(at) - k]
        at = at[score[at] >= kth]
    return at[np.lexsort((ids[at], -score[at]))][:k]


class Cells:
    """Pivots and ring summaries, as every task knows them."""

    def __init__(self, pivots: np.ndarray) -> None:
        self.pivots = pivots

    def place(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ring (cell * RINGS + ring) of each row and its distance from the pivot."""
        width = max(rows.shape[1], self.pivots.shape[1])
        x, p = widened(rows, width).astype(float), widened(self.pivots, width).astype(float)
        cell = np.argmin((p**2).sum(axis=1) - 2 * (x @ p.T), axis=1)
        distance = np.sqrt(((x - p[cell]) ** 2).sum(axis=1))
        ring = np.minimum(np.floor(2 * np.log2(distance + 1)).astype(np.int64), RINGS - 1)
        return cell * RINGS + ring, distance

    def with_summary(self, summary: list) -> Cells:
        self.ring = np.array([r["ring"] for r in summary], np.int64)
        self.count = np.array([r["k"] for r in summary], np.int64)
        self.far = np.array([r["far"] for r in summary], float)
        self.norm = np.array([r["norm"] for r in summary], float)
        return self

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query and ring the least and the highest score possible, rounded outwards."""
        width = max(queries.shape[1], self.pivots.shape[1])
        q, p = widened(queries, width).astype(float), widened(self.pivots, width).astype(float)
        size = np.sqrt((q**2).sum(axis=1))[:, None]
        pivot = self.ring // RINGS
        at, reach = (q @ p.T)[:, pivot], size * self.far
        slack = 1 + 1e-9 * size * (np.sqrt((p**2).sum(axis=1))[pivot] + self.far + self.norm)
        high = np.minimum(at + reach, size * self.norm) + slack
        return np.maximum(at - reach, -size * self.norm) - slack, high

    def least(self, queries: np.ndarray, k: int, own: int = 1) -> np.ndarray:
        """What the k-th best score of each query reaches at least, by the summaries alone, ``own`` rows aside."""
        low, _ = self.bounds(queries)
        order = np.argsort(-low, axis=1, kind="stable")
        held = np.cumsum(self.count[order], axis=1) >= k + own
        at = held.argmax(axis=1)
        rows = np.arange(len(queries))
        return np.where(held.any(axis=1), low[rows, order[rows, at]], -np.inf)


def _prepared(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("id").cast("long").alias("id"), F.col("v").cast("array<long>").alias("v")).where("v is not null")


def top_k(
    queries: DataFrame, rows: DataFrame, k: int = K, n_pivots: int = PIVOTS, n_probes: int = PROBES,
    block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """(query_id, rank, id, score): the k rows with the highest inner product for every query; both inputs are (id long, v array<long>)."""
    out_type = "query_id long, rank int, id long, score long"
    rows, queries = _prepared(rows), _prepared(queries).where("id is not null").groupBy("id").agg(F.min("v").alias("v"))
    # Rows picked by content: the first ones are pivots, all are probes. Both numbers are parameters.
    probes = rows.orderBy(F.xxhash64("v", "id"), "id", "v").limit(max(n_pivots, n_probes)).toArrow()
    if not probes.num_rows:
        return rows.sparkSession.createDataFrame([], out_type)
    probe_rows = matrix(probes["v"])
    probe_ids = probes["id"].to_numpy(zero_copy_only=False) if not probes["id"].null_count else np.array([NO_ID if x is None else x for x in probes["id"].to_pylist()])
    cells = Cells(np.unique(probe_rows[:n_pivots], axis=0))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = 0
        for batch in batches:
            x = matrix(batch["v"])
            ring, far = cells.place(x)
            seat = np.arange(begin, begin + len(x))
            begin += len(x)
            columns = [batch["id"], batch["v"], pa.array(ring), pa.array(far), pa.array(norms(x)), pa.array(seat)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "v", "ring", "far", "norm", "seat"])

    cast = "id long, v array<long>, ring long, far double, norm double, seat long"
    rows = stored(rows.mapInArrow(placed, cast), "rings")
    summary = rows.groupBy("ring").agg(F.count(F.lit(1)).alias("k"), F.max("far").alias("far"), F.max("norm").alias("norm"))
    cells = cells.with_summary(summary.orderBy("ring").collect())

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin = 0
        for batch in batches:
            q, ids = matrix(batch["v"]), batch["id"].to_numpy()
            least = cells.least(q, k)
            near = scores(q, probe_rows)
            for i in range(len(q)):
                others = near[i][probe_ids != ids[i]]
                if len(others) >= k:
                    least[i] = max(least[i], np.partition(others, len(others) - k)[len(others) - k])
            _, high = cells.bounds(q)
            need = [pa.array(cells.ring[h >= t]) for h, t in zip(high, least, strict=True)]
            at_least = pa.array(np.maximum(least, -(2.0**62)).astype(np.int64))
            seat = pa.array(np.arange(begin, begin + len(q)))
            begin += len(q)
            yield pa.RecordBatch.from_arrays([batch["id"], batch["v"], at_least, pa.array(need, pa.list_(pa.int64())), seat], ["id", "v", "least", "rings", "seat"])

    asked = stored(queries.mapInArrow(routed, "id long, v array<long>, least long, rings array<long>, seat long"), "queries")
    demand = {r["ring"]: r["k"] for r in asked.select(F.explode("rings").alias("ring")).groupBy("ring").agg(F.count(F.lit(1)).alias("k")).collect()}
    plan = [(int(r), -(-int(n) // block_rows), -(-demand[int(r)] // block_queries)) for r, n in zip(cells.ring, cells.count, strict=True) if int(r) in demand]
    blocks = F.broadcast(rows.sparkSession.createDataFrame(plan, "b_ring long, row_blocks long, query_blocks long"))

    # A block of rows is copied once for each block of queries of its ring, and the other way round.
    to_all = lambda n: F.explode(F.sequence(F.lit(0), n - 1).cast("array<long>"))
    right = rows.join(blocks, rows.ring == blocks.b_ring).select(
        "ring", F.pmod("seat", "row_blocks").alias("r"), to_all(F.col("query_blocks")).alias("q"), F.lit(1).alias("side"), "id", "v", F.lit(0).cast("long").alias("least")
    )
    left = asked.select("id", "v", "least", "seat", F.explode("rings").alias("ring")).join(blocks, F.col("ring") == blocks.b_ring).select(
        "ring", to_all(F.col("row_blocks")).alias("r"), F.pmod("seat", "query_blocks").alias("q"), F.lit(0).alias("side"), "id", "v", "least"
    )

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, asks, q_ids, q_least, best = None, [], np.zeros((0, 0), np.int64), [], [], []

        def result() -> Iterator[pa.RecordBatch]:
            got = [(i, b) for i, b in zip(q_ids, best, strict=True) if b is not None]
            if got:
                ids = np.concatenate([b[1] for _, b in got])
                columns = [
                    pa.array(np.repeat(np.array([i for i, _ in got]), [len(b[1]) for _, b in got])), pa.array(ids, mask=ids == NO_ID), pa.array(np.concatenate([b[0] for _, b in got])),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["query_id", "id", "score"])

        def meet(part: pa.RecordBatch) -> None:
            ids = np.array([NO_ID if x is None else x for x in part["id"].to_pylist()], np.int64)
            score = scores(asks, matrix(part["v"]))
            for i in range(len(q_ids)):
                own = score[i]
                old, old_ids = best[i] if best[i] is not None else (np.zeros(0, np.int64), np.zeros(0, np.int64))
                other = ids != q_ids[i]
                least = max(q_least[i], int(old[-1])) if len(old) == k else q_least[i]
                if not other.all():
                    own, these = own[other], ids[other]
                else:
                    these = ids
                at = best_of(own, these, k, least)
                if len(at):
                    both, both_ids = np.concatenate([old, own[at]]), np.concatenate([old_ids, these[at]])
                    at = best_of(both, both_ids, k, least)
                    best[i] = both[at], both_ids[at]

        for batch in batches:
            keys = np.stack([batch[c].to_numpy() for c in ("ring", "r", "q", "side")], axis=1)
            cuts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1))) if len(keys) else []
            for begin, end in zip(cuts, [*cuts[1:], len(keys)], strict=True):
                part, key, side = batch.slice(begin, end - begin), tuple(keys[begin][:3]), keys[begin][3]
                if key != block:
                    yield from result()
                    block, held, q_ids, q_least, best = key, [], [], [], []
                if side == 0:
                    held.append(part)
                    continue
                if held:
                    table = pa.Table.from_batches(held)
                    asks, q_ids, q_least = matrix(table["v"]), table["id"].to_pylist(), table["least"].to_pylist()
                    best, held = [None] * len(q_ids), []
                if q_ids:
                    meet(part)
        yield from result()

    pairs = left.union(right).repartition("ring", "r", "q").sortWithinPartitions("ring", "r", "q", "side")
    found = pairs.mapInArrow(solved, "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "id", "score")


def exact_neighbours(vectors: DataFrame, every: int = 100, k: int = K, **sizes: int) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows whose vec_id is divisible by ``every``, against all other rows of (vec_id, embedding)."""
    rows = vectors.select(F.col("vec_id").alias("id"), scaled("embedding").alias("v"))
    return top_k(rows.where(F.col("id") % every == 0), rows, k, **sizes).withColumnRenamed("id", "vec_id")
