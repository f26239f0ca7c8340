"""Tokens of two tokenizers aligned over the bytes of each text, and how often their ids are linked in the whole corpus.

Each text is encoded twice. Byte offsets at which tokens of both end cut it into groups, and an A and a B token are linked if their
byte ranges overlap: one link for each stretch between neighbouring token ends of either side.

Identity-map fast path. An array gives for each A id the B id with the same bytes. A group of one A and one B token that the array
predicts needs no pair: it adds 1 to a vector as long as A's vocabulary, one vector per task, summed by id. Only links of all other groups
are counted as pairs, per chunk of texts first, and go through a shuffle. An id pair's count is the sum of both.

Way back. A chunk (some megabytes of neighbouring texts of one task) asks once for each of its distinct irregular pairs, so a pair
that all texts hold is one row per chunk; the counts of identity pairs and the highest count of each B id are vectors as long as the
vocabularies and travel to all tasks. Texts are tokenised once; what a document needs later (its distinct links with their numbers) is
written to the shared folder.

Defined results: null and empty texts, and texts whose joined A or B bytes differ from space + text (as with U+2581, which B takes for a
space), have no tokens: zeros, and '' for the digest; strings of special tokens are plain text; a text of any length is encoded whole;
repeated rows count and are returned each time; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import stored

A_PATH = "/opt/tokenizers/byte_bpe_50k.json"
B_PATH = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK_BYTES = 2 << 20
#: How a byte-level vocabulary splits text before merging. Fixed value.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
COUNTS = ("n_a", "n_b", "n_groups", "n_links")
ALIGNED = (
    "chunk long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "same array<int>, same_n array<int>, odd array<int>, odd_n array<int>, pair_a array<int>, pair_b array<int>, pair_n array<long>"
)


def _byte_signs() -> dict[str, int]:
    """The sign that stands for each byte in a byte-level vocabulary: itself if it can be seen, else the next code point above 255."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(seen)]
    return {chr(b): b for b in seen} | {chr(256 + n): b for n, b in enumerate(hidden)}


class ByteLevel:
    """A byte-level BPE vocabulary in a .json file. Texts get the leading space from the caller."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        signs, special = _byte_signs(), {x["content"] for x in spec["added_tokens"]}
        vocabulary = spec["model"]["vocab"]
        size = max([*vocabulary.values(), *(x["id"] for x in spec["added_tokens"])]) + 1
        self.bytes_of: list[bytes | None] = [None] * size
        for token, i in vocabulary.items():
            if token not in special:
                self.bytes_of[i] = bytes(signs[c] for c in token)
        ranks = {b: i for i, b in enumerate(self.bytes_of) if b is not None}
        pairs = [m.split(" ", 1) if isinstance(m, str) else m for m in spec["model"]["merges"]]
        order = [vocabulary[x + y] for x, y in pairs]
        before = spec["pre_tokenizer"]
        if order == sorted(order) and before["type"] == "ByteLevel" and before.get("use_regex", True) and spec.get("normalizer") is None:
            # Ids stand in the order of the merges, so the ids are ranks.
            import tiktoken

            own = tiktoken.Encoding(path, pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
            self.encode = lambda texts: [own.encode_ordinary(t) for t in texts]
        else:
            from tokenizers import Tokenizer

            slow = Tokenizer.from_file(path)
            slow.encode_special_tokens = True
            self.encode = lambda texts: [slow.encode(t, add_special_tokens=False).ids for t in texts]


class Pieces:
    """A sentencepiece .model file, which adds the leading space by itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of: list[bytes | None] = []
        self.as_byte = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.as_byte.append(model.is_byte(i))
            if model.is_control(i) or model.is_unknown(i):
                self.bytes_of.append(None)
            else:
                self.bytes_of.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
        self.encode = lambda texts: model.encode([t[1:] for t in texts], num_threads=1)


@dataclass
class Vocabularies:
    """Both tokenizers; ``same[a]`` is the B id with the bytes of a, or -1."""

    a: ByteLevel
    b: Pieces

    def __post_init__(self) -> None:
        # A piece stands before the byte of the same content.
        by_bytes = {x: i for i, x in enumerate(self.b.bytes_of) if x is not None and self.b.as_byte[i]}
        by_bytes |= {x: i for i, x in enumerate(self.b.bytes_of) if x is not None and not self.b.as_byte[i]}
        self.same = np.array([-1 if x is None else by_bytes.get(x, -1) for x in self.a.bytes_of], np.int64)
        self.length_a, self.length_b = (np.array([len(x or b"") for x in side.bytes_of], np.int64) for side in (self.a, self.b))
        as_text = lambda n, sign: np.array([f"{i}{sign}" for i in range(n)], object)
        self.text_a = [as_text(len(self.length_a), s) for s in (",", "|")]
        self.text_b = [as_text(len(self.length_b), s) for s in (",", ";")]


@lru_cache(maxsize=2)
def vocabularies(a_path: str, b_path: str) -> Vocabularies:
    return Vocabularies(ByteLevel(a_path), Pieces(b_path))


@dataclass
class Links:
    """Links of the texts of a chunk. Tokens and links of text i: ranges of the offsets."""

    tokens: tuple[np.ndarray, np.ndarray]
    offsets: tuple[np.ndarray, np.ndarray]
    groups: tuple[np.ndarray, np.ndarray]
    n_groups: np.ndarray
    doc: np.ndarray
    a: np.ndarray
    b: np.ndarray
    regular: np.ndarray


def linked(texts: list[str | None], v: Vocabularies) -> Links:
    """Encodes the texts and links their tokens; texts without tokens have none on either side."""
    spaced = [" " + t if t else None for t in texts]
    known = [i for i, t in enumerate(spaced) if t]
    got = [s.encode([spaced[i] for i in known]) for s in (v.a, v.b)]
    ids: tuple[list, list] = ([[]] * len(texts), [[]] * len(texts))
    for n, i in enumerate(known):
        whole = spaced[i].encode()
        if all(b"".join([side.bytes_of[x] or b"" for x in g[n]]) == whole for side, g in zip((v.a, v.b), got, strict=True)):
            ids[0][i], ids[1][i] = got[0][n], got[1][n]
    counts = [np.fromiter(map(len, x), np.int64, len(texts)) for x in ids]
    offsets = [np.append(0, np.cumsum(c)) for c in counts]
    tokens = [np.fromiter(chain.from_iterable(side), np.int64, int(o[-1])) for side, o in zip(ids, offsets, strict=True)]
    # Ends of all tokens on one axis of bytes: every text starts where the one before it ended.
    ends = [np.cumsum(size[t]) for t, size in zip(tokens, (v.length_a, v.length_b), strict=True)]
    axis = np.zeros(int(ends[0][-1]) + 1 if len(ends[0]) else 1, np.uint8)
    axis[ends[0]] = 1
    axis[ends[1]] += 2
    kind = axis[np.flatnonzero(axis)]
    is_a, is_b, cut = (kind & 1) > 0, kind > 1, kind == 3
    # One link for each end: its A and B token, and its group, by the number of ends before it.
    a_at, b_at, at = (np.cumsum(x) - x for x in (is_a, is_b, cut))
    groups = [at[is_a], at[is_b]]
    n_cuts = int(cut.sum())
    size_a, size_b = (np.bincount(g, minlength=n_cuts) for g in groups)
    a, b = tokens[0][a_at], tokens[1][b_at]
    regular = (size_a[at] == 1) & (size_b[at] == 1) & (v.same[a] == b)
    doc_of = np.repeat(np.arange(len(texts)), counts[0])
    last = np.append(groups[0], n_cuts)[offsets[0]]
    return Links(tuple(tokens), tuple(offsets), tuple(groups), np.diff(last), doc_of[a_at], a, b, regular)


def digests(links: Links, v: Vocabularies) -> list[str]:
    """SHA-256 of the groups of each text as ``a1,a2|b1;a3|b2``; '' for one without tokens."""
    (a, b), (ga, gb) = links.tokens, links.groups
    out = np.empty(len(a) + len(b), object)
    if len(a):
        ends_a, ends_b = (np.append(g[1:] != g[:-1], True) for g in (ga, gb))
        out[np.arange(len(a)) + np.searchsorted(gb, ga, "left")] = np.where(ends_a, v.text_a[1][a], v.text_a[0][a])
        out[np.arange(len(b)) + np.searchsorted(ga, gb, "right")] = np.where(ends_b, v.text_b[1][b], v.text_b[0][b])
    stops = links.offsets[0] + links.offsets[1]
    texts = out.tolist()
    return [sha256("".join(texts[x:y])[:-1].encode()).hexdigest() if y > x else "" for x, y in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)]


def _per_document(doc: np.ndarray, value: np.ndarray, n: int) -> tuple[pa.Array, pa.Array]:
    """Distinct values of each document and how often each occurs, as two list columns."""
    top = int(value.max()) + 1 if len(value) else 1
    keys, times = np.unique(doc * top + value, return_counts=True)
    stops = pa.array(np.searchsorted(keys, np.arange(n + 1) * top).astype(np.int32))
    return tuple(pa.ListArray.from_arrays(stops, pa.array(x.astype(np.int32))) for x in (keys % top, times))


def _chunk(number: int, ids: list, texts: list[str | None], v: Vocabularies) -> tuple[pa.RecordBatch, np.ndarray]:
    """The documents of a chunk, the first one with the chunk's irregular pairs, and the chunk's regular links by A id."""
    links, n = linked(texts, v), len(texts)
    odd = ~links.regular
    width = len(v.b.bytes_of)
    pairs, at, times = np.unique(links.a[odd] * width + links.b[odd], return_inverse=True, return_counts=True)
    same, same_n = _per_document(links.doc[links.regular], links.a[links.regular], n)
    rest, rest_n = _per_document(links.doc[odd], at, n)
    lists = [pa.array([x.tolist()] + [None] * (n - 1), pa.list_(kind)) for x, kind in ((pairs // width, pa.int32()), (pairs % width, pa.int32()), (times, pa.int64()))]
    columns = [
        pa.array(np.full(n, number)), pa.array(ids, pa.int64()), *(pa.array(np.diff(o)) for o in links.offsets), pa.array(links.n_groups),
        pa.array(np.bincount(links.doc, minlength=n)), pa.array(digests(links, v)), same, same_n, rest, rest_n, *lists,
    ]
    names = [x.split()[0] for x in ALIGNED.split(", ")]
    return pa.RecordBatch.from_arrays(columns, names), np.bincount(links.a[links.regular], minlength=len(v.same))


@dataclass
class Aligned:
    """Documents of all chunks as stored, with each chunk's pairs; and the regular links by A id."""

    rows: DataFrame
    a_path: str
    b_path: str

    def pair_counts(self) -> DataFrame:
        """(a, b, n): links of each id pair in the corpus."""
        v = vocabularies(self.a_path, self.b_path)
        spark = self.rows.sparkSession
        odd = self.rows.where("pair_a is not null").select(F.explode(F.arrays_zip("pair_a", "pair_b", "pair_n")).alias("p")).select("p.*")
        # The array is as long as the vocabulary of A.
        same = spark.createDataFrame([(a, int(b)) for a, b in enumerate(v.same) if b >= 0], "a int, b int")
        regular = self._regular().join(F.broadcast(same), "a").select("a", "b", "n")
        return regular.union(odd.toDF("a", "b", "n")).groupBy("a", "b").agg(F.sum("n").alias("n"))

    def _regular(self) -> DataFrame:
        """(a, n) of the regular links, one vector per task."""
        size = len(vocabularies(self.a_path, self.b_path).same)

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size, np.int64)
            for batch in batches:
                ids, times = (batch[c].flatten().to_numpy(zero_copy_only=False) for c in ("same", "same_n"))
                total += np.bincount(ids, weights=times, minlength=size).astype(np.int64)
            a = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int32)), pa.array(total[a])], ["a", "n"])

        return self.rows.select("same", "same_n").mapInArrow(added, "a int, n long")

    def scored(self) -> DataFrame:
        """doc_id, numbers of tokens, groups and links, n_best, count_sum and groups_sha256 of every document."""
        v = vocabularies(self.a_path, self.b_path)
        counts = stored(self.pair_counts(), "pair-counts")
        best, same_n = np.zeros(len(v.b.bytes_of), np.int64), np.zeros(len(v.same), np.int64)
        # Both as long as a vocabulary.
        for r in counts.groupBy("b").agg(F.max("n").alias("n")).toLocalIterator():
            best[r["b"]] = r["n"]
        own = self.rows.sparkSession.createDataFrame([(a, int(b)) for a, b in enumerate(v.same) if b >= 0], "a int, b int")
        for r in counts.join(F.broadcast(own), ["a", "b"]).select("a", "n").toLocalIterator():
            same_n[r["a"]] = r["n"]
        same_best = (same_n == best[v.same]) & (v.same >= 0)

        asked = self.rows.where("pair_a is not null").select("chunk", F.posexplode(F.arrays_zip("pair_a", "pair_b")).alias("at", "p"))
        asked = asked.select("chunk", "at", F.col("p.pair_a").alias("a"), F.col("p.pair_b").alias("b"))
        answers = asked.join(counts, ["a", "b"]).select(F.col("chunk").alias("in_chunk"), "at", "b", "n")

        def answered(docs: pa.Table, answers: pa.Table) -> pa.Table:
            n = answers["n"].to_numpy()
            by_pair, is_best = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            at = answers["at"].to_numpy()
            by_pair[at], is_best[at] = n, n == best[answers["b"].to_numpy()]
            total = np.zeros((2, docs.num_rows), np.int64)
            for name, values in (("same", (same_n, same_best)), ("odd", (by_pair, is_best))):
                column = docs[name].combine_chunks()
                doc = np.repeat(np.arange(docs.num_rows), column.value_lengths().to_numpy())
                ids, times = column.flatten().to_numpy(), docs[f"{name}_n"].combine_chunks().flatten().to_numpy().astype(np.int64)
                for k, x in enumerate(values):
                    np.add.at(total[k], doc, x[ids] * times)
            columns = {c: docs[c] for c in ("doc_id", *COUNTS)}
            return pa.table(columns | {"n_best": total[1], "count_sum": total[0], "groups_sha256": docs["groups_sha256"]})

        kept = self.rows.select("chunk", "doc_id", *COUNTS, "groups_sha256", "same", "same_n", "odd", "odd_n")
        out = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
        return kept.groupBy("chunk").cogroup(answers.groupBy("in_chunk")).applyInArrow(answered, out)


def aligned(docs: DataFrame, a_path: str = A_PATH, b_path: str = B_PATH, chunk_bytes: int = CHUNK_BYTES) -> Aligned:
    """Both encodings of every (doc_id, text), linked and stored."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabularies(a_path, b_path)
        number = TaskContext.get().partitionId() << 32
        ids: list = []
        texts: list[str | None] = []
        held = 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids.append(doc_id)
                texts.append(text.as_py())
                held += len(texts[-1] or "")
                if held >= chunk_bytes or len(ids) >= 10_000:
                    yield _chunk(number, ids, texts, v)[0]
                    number, ids, texts, held = number + 1, [], [], 0
        if ids:
            yield _chunk(number, ids, texts, v)[0]

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encoded, ALIGNED)
    return Aligned(stored(rows, "aligned"), a_path, b_path)


def alignments(docs: DataFrame, a_path: str = A_PATH, b_path: str = B_PATH, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: see ``Aligned.scored``."""
    return aligned(docs, a_path, b_path, chunk_bytes).scored()
