"""Benchmark passages in documents, also reworded ones, by latent semantic retrieval.

Documents are cut into overlapping passages of plain words (lower case, no punctuation). Terms are the words of the benchmark.

1. One pass counts, over all documents, in how many passages each term occurs, and keeps the term numbers of all passages.
2. A randomised SVD of the TF-IDF rows of all passages and of the items (which weigh as much as the corpus) gives RANK latent directions:
   the product of the rows' Gram matrix with COLUMNS sparse random directions is summed on the partitions, ``fit_passages`` at a time, and
   only those sums come back. They are whole numbers, so they do not depend on how rows fall into tasks.
3. A second pass projects every passage and takes its cosine with every item. Lengths are those before the projection, so what
   the directions leave out counts as different; a pair is a candidate from COSINE times the share of the item's length that they keep.
   Blocks of words are summed once; items of up to SHORT words meet passages of 2 blocks, longer ones passages of 4 blocks. An item
   of n words of 24 reaches a cosine of about sqrt(n / 24), so below FULL words COSINE falls with the root of the length.
4. Candidates are checked on the words: the longest common subsequence of the item and a window of 1.4 times its length must reach
   SURE of the item, or LIKELY when the answer, the item's last words, is found in the window as well.
5. Exact copies do not depend on the cosine: places where an item's first ANSWER words stand (all, of a shorter one) are looked up by a
   rolling value, then the whole item is compared there. Items of fewer than ANSWER words are searched in this way alone.

The items are a stated query set: they go to the tasks in blocks of ``block_items``, so what is sent has a bound. Documents are never
shuffled; the result has a row per document.

Defined results: null text has no words and is clean; items without words are ignored, items of fewer than ANSWER words need all their
words in a row; repeated rows are judged alike; an empty benchmark leaves everything clean; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import kept
from . import rolling

BLOCK = 12
SHORT = 30
RANK = 256
COLUMNS = 2 * RANK + 32
UNIT = 1 << 16
BLOCK_TERMS = 32
COSINE = 0.5
FULL = 15
SURE = 0.75
LIKELY = 0.6
ANSWER = 8
ANSWER_SHARE = 0.75
FIT_PASSAGES = 20_000
BLOCK_ITEMS = 5_000
#: Entries of a table of the scores of terms that a task holds.
TABLE = 16 << 20


@dataclass
class Items:
    """A block of benchmark items: ids, word values of each, the sorted terms, and the segments that are compared."""

    ids: list[int]
    words: list[np.ndarray]
    terms: np.ndarray

    @classmethod
    def of(cls, rows: list) -> Items:
        words = rolling.words([(r["text"] or "").encode() for r in rows], fold=True, plain=True)
        parts = [words.values[a:b] for a, b in zip(words.offsets[:-1], words.offsets[1:], strict=True)]
        kept = [(r["item_id"], p) for r, p in zip(rows, parts, strict=True) if len(p)]
        terms = np.unique(np.concatenate([p for _, p in kept])) if kept else np.zeros(0, np.uint64)
        return cls([i for i, _ in kept], [p for _, p in kept], terms)

    def segments(self) -> tuple[list[np.ndarray], np.ndarray]:
        """Term numbers of every item, long ones in halves that overlap, and the item of each."""
        out, of = [], []
        for i, words in enumerate(self.words):
            numbers = np.searchsorted(self.terms, words)
            size = 4 * BLOCK + 2 * BLOCK
            starts = range(0, max(1, len(numbers) - size + 2 * BLOCK), 2 * BLOCK) if len(numbers) > size else [0]
            for s in starts:
                out.append(numbers[s : s + size] if len(numbers) > size else numbers)
                of.append(i)
        return out, np.array(of, np.int64)


def term_numbers(values: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Number of each word's term, -1 for a word that no item has."""
    at = np.searchsorted(terms, values)
    at[at == len(terms)] = 0
    return np.where(terms[at] == values, at, -1)


def _cut(batch: pa.RecordBatch, items: Items) -> Iterator[tuple[int, int, rolling.Words, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts of a batch by pieces: range, words, term numbers, first word of every block, and the text of every block."""
    texts = batch.column("text").cast(pa.binary()).to_pylist()
    for begin, end in rolling.pieces(texts):
        words = rolling.words(texts[begin:end], fold=True, plain=True)
        counts = np.diff(words.offsets)
        blocks = -(-counts // BLOCK)
        of = np.repeat(np.arange(end - begin), blocks)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        yield begin, end, words, term_numbers(words.values, items.terms), words.offsets[of] + nth * BLOCK, of


def _layout(terms: int) -> str:
    return "<u2" if terms < 1 << 16 else "<u4"


def _counter(items: Items, share: float = 1.0):
    """Passages (of 2 blocks of one text) per term, and the passages of every text: their sizes and term numbers, packed.

    ``share`` is of no effect: all passages are kept, whatever the layout of rows.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total, kind = np.zeros(len(items.terms), np.int64), 0, _layout(len(items.terms))
        for batch in batches:
            for _, _, words, numbers, starts, text in _cut(batch, items):
                if not len(starts):
                    continue
                opens = (np.arange(len(text)) - np.searchsorted(text, text)) % 2 == 0
                begins = starts[opens]
                ends = np.r_[begins[1:], len(numbers)]
                known = numbers >= 0
                passage = np.repeat(np.arange(len(begins)), ends - begins)[known]
                numbers = numbers[known]
                pairs = np.unique(passage * len(items.terms) + numbers)
                seen += np.bincount(pairs % len(items.terms), minlength=len(items.terms))
                total += len(begins)
                sizes = np.bincount(passage, minlength=len(begins))
                first = np.r_[np.flatnonzero(np.r_[True, np.diff(text[opens]) > 0]), len(begins)]
                at = np.r_[0, np.cumsum(sizes)][first]
                sizes, packed = sizes.astype(np.uint8).tobytes(), numbers.astype(kind).tobytes()
                width = np.dtype(kind).itemsize
                yield pa.RecordBatch.from_pydict({
                    "term": pa.array(np.full(len(first) - 1, -2, np.int32)),
                    "n": pa.array(np.diff(first)),
                    "passage": pa.array([sizes[p:q] + packed[width * a : width * z] for p, q, a, z in zip(first[:-1], first[1:], at[:-1], at[1:], strict=True)], pa.binary()),
                })
        terms = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({
            "term": pa.array([*terms.tolist(), -1], pa.int32()),
            "n": pa.array([*seen[terms].tolist(), total], pa.int64()),
            "passage": pa.array([None] * (len(terms) + 1), pa.binary()),
        })

    return count


def _directions(terms: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The column that each term is added to and its sign: a sparse random matrix, the identity for few terms."""
    if terms <= COLUMNS:
        return np.arange(terms), np.ones(terms), terms
    draw = np.random.default_rng(7)
    return draw.integers(0, COLUMNS, terms), draw.choice([-1.0, 1.0], terms), COLUMNS


def _some(batches: Iterator[pa.RecordBatch], passages: int) -> Iterator[list[tuple[bytes, int]]]:
    """Packed texts with their numbers of passages, in lists of about so many passages, whatever the size of batches."""
    some, count = [], 0
    for batch in batches:
        for packed, n in zip(batch.column("passage").to_pylist(), batch.column("n").to_pylist(), strict=True):
            some.append((packed, n))
            count += n
            if count >= passages:
                yield some
                some, count = [], 0
    if some:
        yield some


def _product(weights: np.ndarray, fit_passages: int):
    """Sum over passages of row' (row directions), for TF-IDF rows of unit length: rows of a block of terms each.

    Products are rounded to whole multiples of 1 / UNIT, so sums are exact in any order.
    """
    column, sign, width = _directions(len(weights))
    kind = _layout(len(weights))

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(len(weights) * width)
        for some in _some(batches, fit_passages):
            sizes = np.frombuffer(b"".join(x[:n] for x, n in some), np.uint8).astype(np.int64)
            numbers = np.frombuffer(b"".join(x[n:] for x, n in some), kind).astype(np.int64)
            # Passages by falling size: the k-th terms are those of the first ones.
            order = np.argsort(-sizes, kind="stable")
            first, sizes = (np.cumsum(sizes) - sizes)[order], sizes[order]
            at = [numbers[first[: np.searchsorted(-sizes, -k)] + k] for k in range(int(sizes[0]) if len(sizes) else 0)]
            square = np.zeros(len(sizes))
            for i, a in enumerate(at):
                square[: len(a)] += weights[a] ** 2
                for b in at[i + 1 :]:
                    same = np.flatnonzero(a[: len(b)] == b)
                    square[same] += 2 * weights[b[same]] ** 2
            scale = 1 / np.sqrt(np.maximum(square, 1e-18))
            values = [weights[a] * scale[: len(a)] for a in at]
            rows, cols = [a * width for a in at], [column[a] for a in at]
            signed = [v * sign[a] * UNIT for v, a in zip(values, at, strict=True)]
            both = [(i, j, min(len(at[i]), len(at[j]))) for i in range(len(at)) for j in range(len(at))]
            if both:
                place = np.concatenate([rows[i][:n] + cols[j][:n] for i, j, n in both])
                out += np.bincount(place, np.concatenate([np.rint(values[i][:n] * signed[j][:n]) for i, j, n in both]), len(out))
        out = out.reshape(len(weights), width)
        for block in range(0, len(weights), BLOCK_TERMS):
            if (part := out[block : block + BLOCK_TERMS]).any():
                yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "sums": pa.array([part.tobytes()], pa.binary())})

    return product


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of one matrix from those of all tasks."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, packed in zip(batch.column("block").to_pylist(), batch.column("sums").to_pylist(), strict=True):
            part = np.frombuffer(packed)
            total[block] = total[block] + part if block in total else part
    for block, part in total.items():
        yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int32()), "sums": pa.array([part.tobytes()], pa.binary())})


def latent_basis(passages: DataFrame, weights: np.ndarray, own: list[np.ndarray], boost: float, rank: int = RANK, fit_passages: int = FIT_PASSAGES) -> np.ndarray:
    """terms x rank: leading right singular vectors of the TF-IDF rows of all passages and of the items (``own``, each ``boost`` times).

    The product of the rows' Gram matrix with few random directions is summed in one pass, and the matrix is taken to be what these determine.
    """
    column, sign, width = _directions(len(weights))
    blocks = passages.mapInArrow(_product(weights, fit_passages), "block int, sums binary").repartition("block").mapInArrow(_summed, "block int, sums binary")
    moved = np.zeros((len(weights), width))
    for r in blocks.collect():  # terms x width in all
        part = np.frombuffer(r["sums"]).reshape(-1, width) / UNIT
        moved[r["block"] : r["block"] + len(part)] = part
    for numbers in own:
        terms, times = np.unique(numbers, return_counts=True)
        row = times * weights[terms] / max(np.linalg.norm(times * weights[terms]), 1e-9)
        moved[terms] += boost * np.outer(row, np.bincount(column[terms], row * sign[terms], width))
    small = np.zeros((width, width))
    np.add.at(small, column, moved * sign[:, None])
    values, turn = np.linalg.eigh((small + small.T) / 2)
    kept = values > 1e-9 * max(values[-1], 1e-300)
    return np.linalg.svd(moved @ (turn[:, kept] / np.sqrt(values[kept])), full_matrices=False)[0][:, :rank]


def common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, a bit vector over ``a``."""
    masks: dict[int, int] = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    state = full
    for x in b:
        hit = state & masks.get(x, 0)
        state = (state + hit | state - hit) & full
    return len(a) - state.bit_count()


def matched(item: list[int], text: list[int], begin: int, end: int, need: Counter | None = None) -> float:
    """Best share of the item that a window of the text near [begin, end) holds in order; 0 when it is no match. ``need``: its words, counted."""
    n = len(item)
    if n < ANSWER:
        found = any(text[i : i + n] == item for i in range(max(0, begin - n), min(len(text), end) + 1))
        return float(found)
    size, step = -(-14 * n // 10), max(1, n // 5)
    need, tail, best = need or Counter(item), item[-ANSWER:], 0.0
    near = Counter(text[max(0, begin - n) : end + size])
    if sum(min(k, near[w]) for w, k in need.items()) < LIKELY * n:
        return 0.0
    for start in range(max(0, begin - n), max(max(0, begin - n), min(end, len(text) - n // 2)) + 1, step):
        window = text[start : start + size]
        held = Counter(window)
        if sum(min(k, held[w]) for w, k in need.items()) < LIKELY * n:
            continue
        share = common_subsequence(item, window) / n
        answered = common_subsequence(tail, window) >= ANSWER_SHARE * len(tail)
        if share >= SURE or share >= LIKELY and answered:
            best = max(best, share)
    return best


class Spans:
    """Values of runs of words: equal runs have equal values, wherever they begin."""

    def __init__(self, values: np.ndarray):
        base, count = rolling.WORD_BASES[0], len(values)
        self.run = np.zeros(count + 1, np.uint64)
        np.cumsum(values * rolling.powers(base, count), out=self.run[1:])
        self.back = rolling.powers(rolling.inverse(base), count)

    def of(self, at: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        return rolling.mix((self.run[at + n] - self.run[at]) * self.back[at])


def _ranges(keys: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of equal values: numbers of keys, and places in the sorted array."""
    low = np.searchsorted(among, keys)
    n = np.searchsorted(among, keys, side="right") - low
    return np.repeat(np.arange(len(keys)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


class Copies:
    """Finds every exact copy of an item, whatever its length and words."""

    def __init__(self, items: Items):
        self.words = items.words
        size = np.array([len(w) for w in items.words])
        spans = [Spans(w) for w in items.words]
        whole = np.array([s.of(np.zeros(1, np.int64), n)[0] for s, n in zip(spans, size, strict=True)], np.uint64)
        self.order = np.argsort(whole, kind="stable")
        self.whole = whole[self.order]
        # By number of first words: their values with the lengths of items that begin so, each once.
        self.begins = {}
        for k in np.unique(np.minimum(size, ANSWER)).tolist():
            mine = np.flatnonzero(np.minimum(size, ANSWER) == k)
            pairs = sorted({(int(spans[i].of(np.zeros(1, np.int64), k)[0]), int(size[i])) for i in mine})
            self.begins[k] = np.array([p for p, _ in pairs], np.uint64), np.array([n for _, n in pairs])

    def found(self, words: rolling.Words) -> set[tuple[int, int]]:
        """(text, item) of all copies."""
        spans, count, out = Spans(words.values), len(words.values), set()
        for k, (begins, sizes) in self.begins.items():
            first = spans.of(np.arange(max(0, count - k + 1)), k)
            at = np.flatnonzero(rolling.found(first, begins))
            which, place = _ranges(first[at], begins)
            at, size = at[which], sizes[place]
            text = np.searchsorted(words.offsets, at, side="right") - 1
            inside = at + size <= words.offsets[text + 1]
            at, size, text = at[inside], size[inside], text[inside]
            which, place = _ranges(spans.of(at, size), self.whole)
            pairs = np.unique(np.stack([text[which], self.order[place]]), axis=1, return_index=True)
            for (t, i), p in zip(pairs[0].T.tolist(), at[which][pairs[1]].tolist(), strict=True):
                item = self.words[i]
                if np.array_equal(words.values[p : p + len(item)], item):
                    out.add((t, i))
        return out


def _finder(items: Items, weights: np.ndarray, projection: np.ndarray):
    """Per document: matched items with their shares."""
    lists = [w.tolist() for w in items.words]
    needs = [Counter(w) for w in lists]
    segments, of = items.segments()
    queries = np.stack([projection[s].sum(axis=0) for s in segments])
    whole = np.array([np.sqrt((np.unique(s, return_counts=True)[1] ** 2 * weights[np.unique(s)] ** 2).sum()) for s in segments])
    # At least COSINE * |query| / |item| for a cosine of query . passage / (|query| |passage|).
    queries = (queries * (whole / np.maximum((queries**2).sum(axis=1), 1e-9))[:, None]).astype(np.float32)
    lengths = np.array([len(items.words[i]) for i in of])
    queries /= np.sqrt(np.minimum(lengths / FULL, 1))[:, None].astype(np.float32)
    short, long = (lengths >= ANSWER) & (lengths <= SHORT), lengths > SHORT
    copies = Copies(items)
    squares = (weights**2).astype(np.float32)
    vectors = np.vstack([projection, np.zeros((1, projection.shape[1]), np.float32)])
    # With few terms and items the scores of each term are summed by block, else the latent vectors.
    narrow = len(vectors) * len(queries) <= TABLE
    tables = [vectors @ queries[mine].T for mine in (short, long)] if narrow else [vectors]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[dict[int, float]] = [{} for _ in range(batch.num_rows)]
            for begin, _, words, numbers, starts, text in _cut(batch, items):
                if not len(starts):
                    continue
                for doc, c in copies.found(words):
                    found[begin + doc][c] = 1.0
                # Sums of latent vectors by block; unknown words add nothing.
                known = np.flatnonzero(numbers >= 0)
                block = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(numbers)]))[known]
                placed = np.full((len(starts), BLOCK), len(weights))
                placed[block, known - starts[block]] = numbers[known]
                sums = [np.zeros((len(starts) + 4, x.shape[1]), np.float32) for x in tables]
                for column in placed.T:
                    for x, out in zip(tables, sums, strict=True):
                        out[:-4] += x[column]
                length = np.bincount(block, squares[numbers[known]], len(starts) + 4)[:, None]
                same = lambda k: (text == np.r_[text[k:], np.full(k, -1)])[:, None]
                pair = lambda x: x[:-4] + x[1:-3] * same(1)
                # Every other block of each text, so a text's passages do not depend on its neighbours.
                every = np.arange(len(text))
                even = every[(every - np.searchsorted(text, text)) % 2 == 0]
                quad = lambda x: x[even] + x[even + 1] * same(1)[even] + x[even + 2] * same(2)[even] + x[even + 3] * same(3)[even]
                seen: dict[int, list[int]] = {}
                for joined, mine, opens, width, part in ((pair, short, every, 2, sums[0]), (quad, long, even, 4, sums[-1])):
                    picked = np.flatnonzero(mine)
                    if not len(picked):
                        continue
                    scaled = joined(part) / np.sqrt(np.maximum(joined(length), 1e-9)).astype(np.float32)
                    for first in range(0, len(scaled), 4096):
                        some = scaled[first : first + 4096]
                        rows, cols = np.nonzero((some if narrow else some @ queries[picked].T) >= COSINE)
                        for b, c in zip(opens[rows + first].tolist(), of[picked[cols]].tolist(), strict=True):
                            doc = int(text[b])
                            if found[begin + doc].get(c, 0) >= 1:
                                continue
                            if doc not in seen:
                                seen = {doc: words.values[words.offsets[doc] : words.offsets[doc + 1]].tolist()}
                            at = int(starts[b] - words.offsets[doc])
                            share = matched(lists[c], seen[doc], at, at + width * BLOCK, needs[c])
                            if share > found[begin + doc].get(c, 0):
                                found[begin + doc][c] = share
            hits = [[{"item_id": items.ids[c], "share": s} for c, s in sorted(f.items())] for f in found]
            kind = pa.list_(pa.struct([("item_id", pa.int64()), ("share", pa.float64())]))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in batch.schema.names), pa.array(hits, kind)], [*batch.schema.names, "hits"])

    return find


def _prepared(docs: DataFrame, items: Items, fit_passages: int):
    """Statistics, latent space and the finder for one block of items."""
    counting = docs.select("text").mapInArrow(_counter(items), "term int, n long, passage binary")
    with kept(counting, "passages") as counted:
        # A row per term of this block of items.
        rows = counted.where("term > -2").groupBy("term").agg(F.sum("n").alias("n")).collect()
        seen = np.zeros(len(items.terms))
        passages = 0
        for r in rows:
            if r["term"] < 0:
                passages = r["n"]
            else:
                seen[r["term"]] = r["n"]
        weights = np.log((passages + 1) / (seen + 1)) + 0.1
        found = counted.where("term = -2").select("n", "passage")
        basis = latent_basis(found, weights, items.segments()[0], max(passages, 1) / len(items.ids), fit_passages=fit_passages)
    return _finder(items, weights, (weights[:, None] * basis).astype(np.float32))


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, fit_passages: int = FIT_PASSAGES, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """The rows of ``docs`` with ``hits``: (item_id, share) of every benchmark item found in the text."""
    blocks = -(-benchmark.count() // block_items)
    hits = "hits array<struct<item_id: bigint, share: double>>"
    rows = docs.withColumn("hits", F.array().cast("array<struct<item_id: bigint, share: double>>"))
    for block in range(blocks):
        part = benchmark.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        items = Items.of(part.select("item_id", "text").orderBy("item_id", "text").collect())  # one block of the query set
        if items.ids:
            rows = rows.withColumnRenamed("hits", "b_hits")
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
            rows = rows.mapInArrow(_prepared(docs, items, fit_passages), f"{schema}, {hits}")
            rows = rows.withColumn("hits", F.concat("b_hits", "hits")).drop("b_hits")
    return rows


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without those that hold a benchmark item."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), "text")
    return benchmark_hits(rows, benchmark).where(F.size("hits") == 0).select("row.*")
