"""Spelling variants: words one edit apart, found by dynamic programming over sorted lists, and each word's most frequent form.

Words are maximal runs of letters of the whole texts, A-Z in lower case. They are counted per task and merged before the shuffle, so
a word that makes up a third of a corpus is one row per task. ``spoil`` deletes one code point of the runs that a checksum picks.

Near words. Take two words one edit apart, the shorter one of m code points. At any cut c of the shorter one they agree either on
the first c code points or on the last m - c. So every word goes to the lists (m, window) for its own length and for one less,
where a window [a, b) says what may differ: all words of a list share their first a and last m - b code points. The first windows
are the two halves. A list above ``limit`` words is halved again, window by window, until it is small enough or its window is one
code point wide, which the alphabet bounds. A pair is kept in one list only: the one whose window could not move further right.

Inside a list the words stand sorted, and each word is run against those behind it. A row of the edit matrix (three cells around the
diagonal) belongs to a range of words with a common prefix: words next to each other take over the rows of their common prefix, and
a range ends where no cell is below two, so all of its words are skipped. All words of many lists advance together, one code
point at a time, in numpy. Lists come from one exchange and a sort, and are read as a stream.

A word's form is its near word with the largest count (ties: smallest in code-point order) if that is at least twice its own; roots
follow forms to the end. Counts at least double on the way, so following doubles its reach each round and needs few rounds.

Defined results: null and empty texts have no words; a null doc_id counts as empty text in the checksum; repeated rows count each
time; an empty table gives no rows; a run of any length is one word; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.sizing import broadcast_if_small
from .common import stored

MIN_LENGTH = 5
MIN_COUNT = 3
SPOIL = 97
#: Words of a list that is not halved further.
LIMIT = 4096
#: Words that a task counts before it hands them on, and rows that it scans at once.
HELD_WORDS = 200_000
SCAN_ROWS = 60_000
LIST = ("m", "a", "b", "shared")


def _letters() -> bytes:
    """What each Latin-1 byte becomes: a letter in lower case (A-Z only), all else a space."""
    table = bytearray(b" " * 256)
    for c in range(256):
        if 0x61 <= c <= 0x7A or c >= 0xC0:
            table[c] = c
        elif 0x41 <= c <= 0x5A:
            table[c] = c + 32
    return bytes(table)


def _spoilt(run: bytes, start: int, spoil: int) -> bytes:
    """The run, without one code point if its checksum says so; start: the checksum of what stands before it."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
    return run if h % spoil else run[: h % len(run)] + run[h % len(run) + 1 :]


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, spoil: int | None = SPOIL) -> DataFrame:
    """(word, n) of the words of all texts with at least so many code points and occurrences."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, total = _letters(), {}

        def out() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in total], pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(total.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch["id"].to_pylist(), batch["text"], strict=True):
                # Code points above U+00FF become a question mark, which is no letter either.
                runs = Counter((text.as_py() or "").encode("latin-1", "replace").translate(letters).split(b" "))
                runs.pop(b"", None)
                start = zlib.crc32(f"{doc_id or ''}:".encode())
                for run, n in runs.items():
                    word = _spoilt(run, start, spoil) if spoil else run
                    if len(word) >= min_length:
                        total[word] = total.get(word, 0) + n
                if len(total) >= HELD_WORDS:
                    yield out()
                    total.clear()
        if total:
            yield out()

    found = docs.select(F.col("doc_id").cast("string").alias("id"), F.col("text")).mapInArrow(counted, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _in_window(rows: DataFrame, windows: Column) -> DataFrame:
    """A row (m, a, b, shared, word, n) for each window (a, b) of each row (m, word, n)."""
    rows = rows.select("m", "word", "n", F.explode(windows).alias("w")).select("m", "w.a", "w.b", "word", "n")
    ends = F.col("m") - F.col("b")
    shared = F.concat(F.substr("word", F.lit(1), F.col("a")), F.lit(" "), F.substr("word", F.length("word") - ends + 1, ends))
    return rows.select("m", "a", "b", shared.alias("shared"), "word", "n")


def _halves(a: Column, b: Column) -> Column:
    middle = F.floor((a + b) / 2).cast("int")
    return F.array(F.struct(middle.alias("a"), b.alias("b")), F.struct(a.alias("a"), middle.alias("b")))


def lists(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """All words in all of their lists; no list has over ``limit`` words unless its window is one code point wide."""
    m = F.explode(F.array(F.length("word") - 1, F.length("word"))).alias("m")
    rows = words.where(F.length("word") >= 1).select("word", "n", m).where("m >= 1")
    rows = _in_window(rows, F.when(F.col("m") == 1, F.array(F.struct(F.lit(0).alias("a"), F.col("m").alias("b")))).otherwise(_halves(F.lit(0), F.col("m"))))
    while True:
        large = rows.where("b - a > 1").groupBy(*LIST).agg(F.count(F.lit(1)).alias("k")).where(F.col("k") > limit).drop("k")
        large = stored(large, "large-lists")
        if large.isEmpty():
            return rows
        marked, _ = broadcast_if_small(large.withColumn("large", F.lit(True)))
        rows = stored(rows.join(marked, list(LIST), "left"), "lists")
        same = F.array(F.struct("a", "b"))
        rows = _in_window(rows, F.when(F.col("large"), _halves(F.col("a"), F.col("b"))).otherwise(same))


def _common_prefixes(codes: np.ndarray, at: np.ndarray, length: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Length of the prefix that each word shares with the word before it; -1 for the first of a list."""
    lcp = np.where(first, -1, 0)
    open_ = np.flatnonzero(~first)
    depth = 0
    while len(open_):
        same = (length[open_] > depth) & (length[open_ - 1] > depth)
        open_ = open_[same]
        open_ = open_[codes[at[open_] + depth] == codes[at[open_ - 1] + depth]]
        depth += 1
        lcp[open_] = depth
    return lcp


def scan(texts: list[str], first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions i < j of all texts of one list that are one edit apart; the lists are sorted, ``first`` marks where each begins."""
    n = len(texts)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    length = np.fromiter(map(len, texts), np.int64, n)
    at = np.zeros(n, np.int64)
    np.cumsum(length[:-1] + 2, out=at[1:])
    codes = np.frombuffer("".join(t + "\0\0" for t in texts).encode("utf-32-le"), np.uint32)
    lcp = _common_prefixes(codes, at, length, first)
    begins = np.flatnonzero(first)
    stop = np.repeat(np.append(begins[1:], n), np.diff(np.append(begins, n)))
    word = np.arange(n)
    low, high = word + 1, stop
    keep = low < high
    word, low, high = word[keep], low[keep], high[keep]
    # Edits that turn the first d - 1, d and d + 1 code points of the word into the d of the range's prefix; 2 stands for more.
    left, same, right = np.full(len(word), 2, np.int8), np.zeros(len(word), np.int8), np.ones(len(word), np.int8)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    depth = 0
    while len(word):
        # A word that ends here is the first of its range.
        done = length[low] == depth
        if done.any():
            gap = length[word] - depth
            edits = np.select([gap == -1, gap == 0, gap == 1], [left, same, right], 2)
            hit = done & (edits == 1)
            found.append((word[hit], low[hit]))
            low = low + done
            keep = low < high
            word, low, high, left, same, right = (x[keep] for x in (word, low, high, left, same, right))
            if not len(word):
                break
        # Ranges with one more common code point: cut where a word shares no more than depth with the one before it.
        cuts = np.flatnonzero(lcp <= depth)
        begin, end = np.searchsorted(cuts, low, "right"), np.searchsorted(cuts, high, "left")
        parts = end - begin + 1
        whole = np.repeat(np.arange(len(word)), parts)
        nth = np.arange(len(whole)) - np.repeat(np.cumsum(parts) - parts, parts)
        cut_at = np.append(cuts, n)
        new_low = np.where(nth == 0, low[whole], cut_at[np.minimum(begin[whole] + nth - 1, len(cuts))])
        new_high = np.where(nth == parts[whole] - 1, high[whole], cut_at[np.minimum(begin[whole] + nth, len(cuts))])
        word, low, high, left, same, right = word[whole], new_low, new_high, left[whole], same[whole], right[whole]
        sign, own, size = codes[at[low] + depth], at[word], length[word]
        sign_at = lambda j: codes[own + np.clip(j, 0, size + 1)] != sign
        new_left = np.minimum(left + (sign_at(depth - 1) if depth else 1), same + 1)
        new_left = np.where(size >= depth, new_left, 2)
        new_same = np.minimum(np.minimum(same + sign_at(depth), right + 1), new_left + 1)
        new_same = np.where(size >= depth + 1, new_same, 2)
        new_right = np.where(size >= depth + 2, np.minimum(right + sign_at(depth + 1), new_same + 1), 2)
        keep = np.minimum(np.minimum(new_left, new_same), new_right) < 2
        word, low, high = word[keep], low[keep], high[keep]
        left, same, right = (np.minimum(x[keep], 2).astype(np.int8) for x in (new_left, new_same, new_right))
        depth += 1
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


def _pairs_of(rows: pa.Table) -> pa.Table:
    """Near pairs of whole lists, each pair in the one list that keeps it."""
    n = rows.num_rows
    changed = np.zeros(n, bool)
    changed[:1] = True
    for name in LIST:
        column = rows[name].combine_chunks()
        changed[1:] |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    sizes = np.diff(np.append(np.flatnonzero(changed), n))
    keep = np.repeat(sizes, sizes) > 1
    rows, first = rows.filter(pa.array(keep)), changed[keep]
    words = rows["word"].to_pylist()
    m, a, b = (rows[x].to_numpy() for x in ("m", "a", "b"))
    free = [w[x : len(w) - y] for w, x, y in zip(words, a.tolist(), (m - b).tolist(), strict=True)]
    i, j = scan(free, first)
    length = np.fromiter(map(len, free), np.int64, len(free))
    width = (b - a)[i]
    short = np.minimum(length[i], length[j]) == width
    # A code point more at the end of the window: the pair agrees on the whole window and is kept by the list to the right, if any.
    longer = short & (length[i] != length[j]) & (b[i] < m[i])
    for k in np.flatnonzero(longer).tolist():
        short[k] = free[i[k]][: width[k]] != free[j[k]][: width[k]]
    i, j = pa.array(i[short]), pa.array(j[short])
    return pa.table({"word": rows["word"].take(i), "n": rows["n"].take(i), "near": rows["word"].take(j), "near_n": rows["n"].take(j)})


def near_words(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(word, n, near, near_n): each pair of words that are one edit apart, once."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def ready(last: bool) -> Iterator[pa.RecordBatch]:
            """Pairs of the lists that are complete; the last list stays unless nothing follows."""
            nonlocal held, rows
            table = pa.Table.from_batches(held)
            keys = [table[x].to_pylist() for x in LIST]
            n, end = table.num_rows, table.num_rows
            if not last:
                tail = tuple(k[-1] for k in keys)
                while end and tuple(k[end - 1] for k in keys) == tail:
                    end -= 1
            begin = 0
            while begin < end:
                # Words of like length together, so that the longest one does not set the pace of many short ones.
                stop = begin
                most = 2 * keys[0][begin]
                while stop < end and keys[0][stop] <= most:
                    stop += 1
                yield from _pairs_of(table.slice(begin, stop - begin)).to_batches()
                begin = stop
            held, rows = (table.slice(end).to_batches() if end < n else []), n - end

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= SCAN_ROWS:
                yield from ready(False)
        if held:
            yield from ready(True)

    rows = lists(words, limit)
    free = F.substr("word", F.col("a") + 1, F.length("word") - F.col("m") + F.col("b") - F.col("a"))
    rows = rows.repartition(*LIST).sortWithinPartitions(*LIST, free)
    return rows.mapInArrow(scanned, "word string, n long, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: the end of the chain of forms."""
    chain = stored(forms.where("form is not null").select("word", F.col("form").alias("root")), "roots")
    while True:
        further = chain.select(F.col("word").alias("r_word"), F.col("root").alias("r_root"))
        moved = chain.join(further, chain.root == further.r_word, "left")
        moved = stored(moved.select("word", F.coalesce("r_root", "root").alias("root"), F.col("r_root").isNotNull().alias("moved")), "roots")
        chain = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return chain


def spelling_forms(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Form, root and near-word count of every word of a vocabulary (word, n)."""
    words = stored(words.select("word", "n"), "vocabulary")
    pairs = near_words(words, limit)
    ways = [F.struct("word", "n", "near", "near_n"), F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))]
    both = pairs.select(F.explode(F.array(*ways)).alias("p")).select("p.*")
    alone = words.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n"))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("minus"), "near"))).alias("best")
    forms = both.union(alone).groupBy("word").agg(F.max("n").alias("n"), F.count("near").alias("n_near"), best)
    known = -F.col("best.minus") >= 2 * F.col("n")
    forms = forms.select("word", "n", "n_near", F.when(known, F.col("best.near")).alias("form"), F.when(known, -F.col("best.minus")).alias("form_n"))
    forms = stored(forms, "forms")
    ends = roots(forms).withColumnRenamed("word", "r_word")
    return forms.join(ends, forms.word == ends.r_word, "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, spoil: int | None = SPOIL) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the documents."""
    return spelling_forms(vocabulary(docs, min_length, min_count, spoil))
