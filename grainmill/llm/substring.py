"""Exact repeats of 20 or more words, by fixed-block anchors.

Every text is cut into non-overlapping blocks of 10 words, the reference blocks. A repeated window of 20 words holds a whole
block of its first occurrence, and the later one holds the same ten words at some place, so probing the blocks with every
rolling window of ten words misses no repeat. Hits are then extended: the windows of 20 words around a hit are compared
with all others around hits, and overlapping repeated windows join into maximal repeated spans.

Texts are dealt into chunks by doc_id, values into buckets. A chunk sends each bucket one packed array of its distinct values and
gets back the few that matter, so a passage that fills a third of the corpus costs one entry per chunk, and no pairs are made:

1. chunk -> bucket: 32 bits of each rolling ten-word value (the bucket is another part of it) and whether it is a block;
2. bucket -> chunk: values of blocks that occur again. A false hit by equal bits only adds a window to step 3;
3. chunk -> bucket: 64 bits of each 20-word window near a hit (the bucket from a second value) and its smallest doc_id;
4. bucket -> chunk: windows that start earlier in another chunk. Inside a chunk the order of texts and places decides.

The texts are exchanged once; the three passes read the same exchange. A lost executor's part is computed again.

Defined results: null text has no words; null doc_ids come after all others, in an order that follows from their texts alone; rows that
share a doc_id are taken in the order of their texts; a repeated row loses all windows that its first copy has; an empty table gives no rows; other columns are dropped.
doc_id is an integer.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from . import rolling

WINDOW = 20
BLOCK = 10
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 4 << 20
LAST = np.iinfo(np.int64).max
PACKED = "bucket int, chunk int, keys binary, more binary"


def _texts(table: pa.Table) -> tuple[np.ndarray, list, pa.Table]:
    """doc_ids (null last), texts as bytes, and the rows, all in the order of doc_id and text."""
    table = table.select(["chunk", "doc_id", "text"]).set_column(2, "text", table["text"].cast(pa.binary()))
    order = pc.sort_indices(table.select(["doc_id", "text"]), sort_keys=[("doc_id", "ascending"), ("text", "ascending")])
    table = table.take(order)
    ids = pc.fill_null(table["doc_id"].cast(pa.int64()), int(LAST)).to_numpy()
    return ids, table["text"].to_pylist(), table


def _pack(chunk: int, bucket: np.ndarray, n: int, keys: np.ndarray, more: np.ndarray) -> pa.Table:
    """Rows of packed arrays, one for each filled bucket; ``bucket`` is in order."""
    cuts = np.searchsorted(bucket, np.arange(n + 1))
    full = np.flatnonzero(np.diff(cuts))
    return pa.table({
        "bucket": pa.array(full, pa.int32()),
        "chunk": pa.array(np.full(len(full), chunk), pa.int32()),
        "keys": pa.array([keys[cuts[b] : cuts[b + 1]].tobytes() for b in full], pa.binary()),
        "more": pa.array([more[cuts[b] : cuts[b + 1]].tobytes() for b in full], pa.binary()),
    })


def _runs(ordered: np.ndarray) -> np.ndarray:
    """Places where a new value begins in an ordered array."""
    return np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, np.int64)


def _anchor(values: np.ndarray, n: int) -> np.ndarray:
    """Bucket and low 32 bits of a value in one number."""
    return (rolling.bucket_of(values, n) << 32) | (values & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _send_blocks(n: int):
    def send(table: pa.Table) -> pa.Table:
        _, texts, _ = _texts(table)
        chunk = table["chunk"][0].as_py()
        words = rolling.words(texts)
        inside = words.inside(BLOCK)
        place = np.arange(len(words.values)) - np.repeat(words.offsets[:-1], np.diff(words.offsets))
        keys = _anchor(words.windows(BLOCK)[inside], n)
        # The lowest bit says that the window is a reference block.
        keys = np.sort((keys << 1) | (place[inside] % BLOCK == 0))
        first = _runs(keys >> 1)
        again = np.diff(np.r_[first, len(keys)]) > 1
        block = keys[np.r_[first[1:], len(keys)] - 1] & 1 if len(keys) else np.zeros(0, np.int64)
        kept = keys[first] >> 1
        return _pack(chunk, kept >> 32, n, kept.astype(np.uint32), (block + 2 * again).astype(np.uint8))

    return send


def _unpack(table: pa.Table, key: type, more: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys and what comes with them of all rows, and the number of the row of each."""
    keys = [np.frombuffer(x, key) for x in table["keys"].to_pylist()]
    rest = [np.frombuffer(x, more) for x in table["more"].to_pylist()]
    return np.concatenate(keys), np.concatenate(rest), np.repeat(np.arange(len(keys)), [len(k) for k in keys])


def _answer(table: pa.Table, rows: np.ndarray, keys: np.ndarray) -> pa.Table:
    """Keys back to the chunks that sent them; ``rows`` is in order."""
    cuts = np.searchsorted(rows, np.arange(table.num_rows + 1))
    full = np.flatnonzero(np.diff(cuts))
    none = [b""] * len(full)
    return pa.table({
        "bucket": table["bucket"].combine_chunks().take(pa.array(full)), "chunk": table["chunk"].combine_chunks().take(pa.array(full)),
        "keys": pa.array([keys[cuts[i] : cuts[i + 1]].tobytes() for i in full], pa.binary()), "more": pa.array(none, pa.binary()),
    })


def _repeated_blocks(table: pa.Table) -> pa.Table:
    """Values that are a reference block somewhere and occur at least twice."""
    keys, flags, row = _unpack(table, np.uint32, np.uint8)
    order = np.argsort(keys, kind="stable")
    first = _runs(keys[order])
    n = np.diff(np.r_[first, len(keys)])
    any_of = np.bitwise_or.reduceat(flags[order], first)
    hit = ((any_of & 1) > 0) & ((n > 1) | ((any_of & 2) > 0))
    mine = np.empty(len(keys), bool)
    mine[order] = np.repeat(hit, n)
    return _answer(table, row[mine], keys[mine])


def _hits(answers: pa.Table) -> np.ndarray:
    buckets = answers["bucket"].to_numpy()
    parts = [(np.int64(b) << 32) | np.frombuffer(k, np.uint32).astype(np.int64) for b, k in zip(buckets, answers["keys"].to_pylist(), strict=True)]
    return np.sort(np.concatenate(parts)) if parts else np.zeros(0, np.int64)


def _nothing() -> pa.Table:
    return _pack(0, np.zeros(0, np.int64), 1, np.zeros(0, np.uint32), np.zeros(0, np.uint8))


def _send_windows(n: int):
    def send(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows or not answers.num_rows:
            return _nothing()
        ids, texts, _ = _texts(table)
        words = rolling.words(texts)
        hit = rolling.found(_anchor(words.windows(BLOCK), n), _hits(answers)) & words.inside(BLOCK)
        upto = np.r_[0, np.cumsum(hit)]
        reach = WINDOW - BLOCK + 1
        near = np.zeros(len(hit), bool)
        near[: max(0, len(hit) - reach + 1)] = upto[reach:] > upto[:-reach] if len(hit) >= reach else False
        near &= words.inside(WINDOW)
        keys = words.windows(WINDOW)[near]
        bucket = rolling.bucket_of(words.windows(WINDOW, rolling.WORD_BASES[1])[near], n)
        doc = np.repeat(ids, np.diff(words.offsets))[near]
        order = np.lexsort((keys, bucket))  # stable: the smallest doc_id of equal windows stays first
        keys, bucket, doc = keys[order], bucket[order], doc[order]
        first = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (bucket[1:] != bucket[:-1])]) if len(keys) else np.zeros(0, int)
        return _pack(table["chunk"][0].as_py(), bucket[first], n, keys[first], doc[first])

    return send


def _later_windows(table: pa.Table) -> pa.Table:
    """Windows that a chunk does not have first."""
    keys, doc, row = _unpack(table, np.uint64, np.int64)
    order = np.lexsort((table["chunk"].to_numpy()[row], doc, keys))
    first = _runs(keys[order])
    later = np.ones(len(keys), bool)
    later[order[first]] = False
    return _answer(table, row[later], keys[later])


def _cut(n: int):
    def cut(table: pa.Table, answers: pa.Table) -> pa.Table:
        _, texts, rows = _texts(table)
        words = rolling.words(texts)
        inside = words.inside(WINDOW)
        place = np.flatnonzero(inside)
        keys = words.windows(WINDOW)[place]
        bucket = rolling.bucket_of(words.windows(WINDOW, rolling.WORD_BASES[1])[place], n)
        repeated = np.zeros(len(keys), bool)
        order = np.lexsort((bucket, keys))
        k, b = keys[order], bucket[order]
        repeated[order[1:][(k[1:] == k[:-1]) & (b[1:] == b[:-1])]] = True
        if answers.num_rows:
            sets = sorted(zip(answers["bucket"].to_pylist(), answers["keys"].to_pylist(), strict=True), key=lambda x: x[0])
            among = np.concatenate([np.frombuffer(x, np.uint64) for _, x in sets])
            of = np.repeat([x for x, _ in sets], [len(x) // 8 for _, x in sets])
            # Values are compared first; a value in two buckets is rare and is looked up in both.
            hit = np.flatnonzero(rolling.found(keys, np.sort(among)))
            pair = np.rec.fromarrays([among, of], names="k,b")
            repeated[hit[np.isin(np.rec.fromarrays([keys[hit], bucket[hit]], names="k,b"), pair)]] = True
        edge = np.zeros(len(words.values) + WINDOW + 1, np.int32)
        starts = place[repeated]
        np.add.at(edge, starts, 1)
        np.add.at(edge, starts + WINDOW, -1)
        gone = np.cumsum(edge)[: len(words.values)] > 0
        kept_texts, removed, spans = [], [], []
        for i, text in enumerate(texts):
            begin, end = words.offsets[i], words.offsets[i + 1]
            mask = gone[begin:end]
            count = int(mask.sum())
            split = (text or b"").split()
            kept_texts.append(b" ".join(compress(split, ~mask) if count else split))
            removed.append(count)
            turns = np.flatnonzero(np.diff(np.r_[False, mask, False].astype(np.int8))).reshape(-1, 2).tolist() if count else []
            spans.append([{"first": a, "end": b} for a, b in turns])
        return pa.table({
            "doc_id": rows["doc_id"].cast(pa.int64()), "text": pa.array(kept_texts, pa.binary()).cast(pa.string()),
            "n_words": pa.array(np.diff(words.offsets), pa.int64()), "n_removed": pa.array(removed, pa.int64()),
            "spans": pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))),
        })

    return cut


def chunked(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, int]:
    """(chunk, doc_id, text) with chunks of about so many bytes by doc_id (by text without one), and the bytes of all texts."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // chunk_bytes))
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    return docs.select(F.pmod(key, F.lit(n)).cast("int").alias("chunk"), "doc_id", "text"), total


def without_repeats(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """doc_id, text (kept words joined by a space), n_words, n_removed, and the removed spans of words."""
    parts, total = chunked(docs, chunk_bytes)
    n = max(1, -(-total // bucket_bytes))
    by_chunk = parts.groupBy("chunk")
    blocks = by_chunk.applyInArrow(_send_blocks(n), PACKED).groupBy("bucket").applyInArrow(_repeated_blocks, PACKED)
    windows = by_chunk.cogroup(blocks.groupBy("chunk")).applyInArrow(_send_windows(n), PACKED)
    later = windows.groupBy("bucket").applyInArrow(_later_windows, PACKED)
    schema = "doc_id long, text string, n_words long, n_removed long, spans array<struct<first: int, end: int>>"
    return by_chunk.cogroup(later.groupBy("chunk")).applyInArrow(_cut(n), schema)
