"""Language-model scores from a hierarchical Pitman-Yor model of word pairs, seated by Gibbs sampling on Spark.

Every word is the context restaurant of the words that follow it; all restaurants share one parent, the restaurant of single words,
whose own parent is uniform over the known words and one unknown. A customer of dish w in context u sits at a new table with a chance in
proportion to (STRENGTH + DISCOUNT * tables) * P(w | parent), at an old one in proportion to customers - DISCOUNT * tables of w. A Gibbs
sweep unseats the customers of each dish in turn and seats them again, given all other dishes; after BURN sweeps, SAMPLES are averaged. The
first sweep takes the expected number of tables at rest, as a large context that starts from one table per dish grows for many sweeps. Each
table sends one customer to the parent, which is sampled in the same way. The prediction is

    P(w | u) = (c_uw - d t_uw) / (s + c_u) + (s + d t_u) / (s + c_u) * P(w),   P(w) likewise from the tables and 1 / (V + 1).

How it runs. Texts are dealt into chunks, words into buckets. Chunks and buckets exchange packed arrays:

1. chunk -> word bucket: its distinct words with training counts; back come a number for each known word and its count;
2. chunk -> context bucket: its distinct pairs of known words with training counts. A context of more than ``hot`` customers is split by its
   dishes into parts; its number of customers is known from step 1. Each part sends one small row, the tables it expects for GRID numbers
   of tables in the whole context; where their sum equals that number the sampler is at rest, and every part gets this number back.
   A chunk names only parts that hold one of its pairs, so what it sends does not grow with the parts of the corpus;
3. context bucket: seats the pairs; each pair's discounted count goes back to the chunks, the tables of each word go on to its word bucket,
   and so do those of each part of a context, to the bucket of the context's word, where they are added up once;
4. word bucket: seats the parent restaurant and answers the chunks, with the tables that each word has as a context; totals are one row
   that goes to every chunk;
5. chunk: scores its texts.

In step 3 the parent is taken to be the words' relative frequency (sent in eighths of a doubling); the final P(w) has the sampled tables. The
first 64 customers of a dish are seated one by one, later ones in runs of a sixteenth of those seated, so a word of any frequency takes
few steps. Random numbers are a function of word, context, sweep and customer. Everything grows with the input, and nothing but the totals
meets in one task.

Defined results: null text is the empty text, whose only token is the end; a null doc_id counts as the empty id (for training too);
repeated rows count as often as they occur; with no training rows every word is unknown; an empty table gives no rows; doc_id is an integer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from . import rolling
from .common import words as word_array

STRENGTH, DISCOUNT = 2.0, 0.75
PARENT_STRENGTH, PARENT_DISCOUNT = 10.0, 0.7
BURN, SAMPLES = 2, 3
GRID = 48
HALVINGS = 8
FOLDS, HELD_OUT = 7, 2
CHUNK_BYTES = 12 << 20
BUCKET_BYTES = 8 << 20
END = np.uint64(0x51ED270B9F3C7A15)
ONE_BY_ONE = 64
#: Arrays of one, as numpy warns when a single number wraps.
_GOLD, _WORD, _PART = (np.array([x], np.uint64) for x in (0x9E3779B97F4A7C15, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))
MESSAGE = "kind int, target int, bucket int, keys binary, more binary, s1 double, s2 double, s3 double"
PAIRS_BACK, TABLES_ON, WORDS_BACK, TOTALS, SETTLED, CONTEXTS_ON = 1, 2, 3, 4, 5, 6


def held_out(doc_id: str) -> Column:
    """Whether a document is kept from training."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == HELD_OUT


def _planes(values: np.ndarray, kind: str = "<u4") -> bytes:
    """The bytes of an array, first bytes first: high bytes that are zero compress to nothing."""
    flat = np.ascontiguousarray(values.astype(kind)).view(np.uint8)
    return np.ascontiguousarray(flat.reshape(len(values), -1).T).tobytes() if len(values) else b""


def _unplaned(data: bytes, n: int, kind: str = "<u4") -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8, n * width).reshape(width, n).T).view(kind).reshape(-1)


def _messages(rows: list[tuple]) -> pa.Table:
    """(kind, target, bucket, keys, more[, s1, s2, s3]) rows."""
    rows = [(*r, *[0.0] * (8 - len(r))) for r in rows]
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
    types = [pa.int32()] * 3 + [pa.binary()] * 2 + [pa.float64()] * 3
    names = ["kind", "target", "bucket", "keys", "more", "s1", "s2", "s3"]
    return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, types, strict=True)})


class Chunk:
    """Tokens of a chunk: words of each text and its end, as numbers of the sorted distinct ones."""

    def __init__(self, table: pa.Table):
        self.ids = table["doc_id"]
        self.held = table["held"].to_numpy()
        words = rolling.words(table["text"].cast(pa.binary()).to_pylist(), fold=True)
        tokens = np.insert(words.values, words.offsets[1:], END)
        self.counts = np.diff(words.offsets) + 1
        self.doc = np.repeat(np.arange(len(self.counts)), self.counts)
        self.distinct, self.token = np.unique(tokens, return_inverse=True)
        self.trains = ~self.held[self.doc]
        self.before = np.r_[0, self.token[:-1]]
        self.before[np.r_[0, np.cumsum(self.counts)[:-1]]] = np.searchsorted(self.distinct, END)


def _send_words(n: int):
    def send(table: pa.Table) -> pa.Table:
        chunk = Chunk(table)
        count = np.bincount(chunk.token, chunk.trains, len(chunk.distinct)).astype(np.int64)
        cuts = np.searchsorted(rolling.bucket_of(chunk.distinct, n), np.arange(n + 1))
        number = table["chunk"][0].as_py()
        return _messages([
            (0, -1 - b, number, chunk.distinct[a:z].tobytes(), _planes(count[a:z]))
            for b, (a, z) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if z > a
        ])

    return send


def _numbered(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, int]:
    """For the word rows of a bucket: number of each row's words among the known ones (-1), the counts of all known, how many."""
    keys = [np.frombuffer(k, np.uint64) for k in table["keys"].to_pylist()]
    counts = [_unplaned(m, len(k)).astype(np.int64) for k, m in zip(keys, table["more"].to_pylist(), strict=True)]
    values, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, np.concatenate(counts), len(values)).astype(np.int64)
    known = np.cumsum(total > 0) - 1
    number = np.where(total > 0, known, -1)
    return [number[np.searchsorted(values, k)] for k in keys], total[total > 0], values[total > 0], int((total > 0).sum())


def _number_words(table: pa.Table) -> pa.Table:
    """Number + 1 (0: unknown) and count of every word, to the chunk that sent it."""
    numbers, total, _, _ = _numbered(table)
    bucket = -1 - table["target"][0].as_py()
    padded = np.r_[total, 0]
    return _messages([
        (0, c, bucket, _planes(x + 1), _planes(padded[x])) for c, x in zip(table["bucket"].to_pylist(), numbers, strict=True)
    ])


def _pairs(chunk: Chunk, known: np.ndarray, count: np.ndarray, n: int, hot: int):
    """Contexts and pairs of a chunk in the order in which they are sent.

    Returns the parts of contexts that hold a pair of the chunk (context word, part, bucket), the distinct pairs (part row, dish word)
    and the pair of each token (-1 without).
    """
    size = np.int64(len(chunk.distinct))
    both = known[chunk.before] & known[chunk.token]
    key = chunk.before.astype(np.int64) * size + chunk.token
    distinct, place = np.unique(key[both], return_inverse=True)
    u, w = distinct // size, distinct % size
    split = 1 + count // hot
    part = (rolling.mix(chunk.distinct[w]) % split[u].astype(np.uint64)).astype(np.int64)
    values = np.where(part == 0, chunk.distinct[u], rolling.mix(chunk.distinct[u] + part.astype(np.uint64) * _PART))
    bucket = rolling.bucket_of(values, n)
    moved = np.lexsort((part, u, bucket))
    back = np.empty(len(moved), np.int64)
    back[moved] = np.arange(len(moved))
    of_token = np.full(len(chunk.token), -1)
    of_token[both] = back[place]
    u, w, part, bucket = u[moved], w[moved], part[moved], bucket[moved]
    new = np.ones(len(u), bool)
    new[1:] = (bucket[1:] != bucket[:-1]) | (u[1:] != u[:-1]) | (part[1:] != part[:-1])
    return (u[new], part[new], bucket[new]), (np.cumsum(new) - 1, w), of_token


def _send_pairs(n: int, hot: int):
    def send(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows or not answers.num_rows:
            return _messages([])
        chunk = Chunk(table)
        answers = answers.sort_by("bucket")
        sizes = np.diff(np.searchsorted(rolling.bucket_of(chunk.distinct, n), np.arange(n + 1)))
        sizes = sizes[sizes > 0]
        number = np.concatenate([_unplaned(k, s) for k, s in zip(answers["keys"].to_pylist(), sizes, strict=True)])
        count = np.concatenate([_unplaned(m, s) for m, s in zip(answers["more"].to_pylist(), sizes, strict=True)]).astype(np.int64)
        (u, part, bucket), (row, w), of_token = _pairs(chunk, number > 0, count, n, hot)
        fits = of_token >= 0
        times = np.bincount(of_token[fits], chunk.trains[fits], len(w)).astype(np.int64)
        own = rolling.bucket_of(chunk.distinct, n)
        frequency = np.round(8 * np.log2(np.maximum(count, 1)))
        cuts, rows = np.searchsorted(bucket, np.arange(n + 1)), []
        ends = np.searchsorted(row, cuts)
        me = table["chunk"][0].as_py()
        for b in np.flatnonzero(np.diff(cuts)):
            p, q = slice(cuts[b], cuts[b + 1]), slice(ends[b], ends[b + 1])
            heads = [own[u[p]], number[u[p]], part[p], np.bincount(row[q] - cuts[b], minlength=cuts[b + 1] - cuts[b]), count[u[p]]]
            body = [own[w[q]], number[w[q]], times[q]]
            rows.append((0, int(b), me, b"".join(_planes(x) for x in heads), b"".join([*(_planes(x) for x in body), frequency[w[q]].astype(np.uint8).tobytes()])))
        return _messages(rows)

    return send


def seated(customers: np.ndarray, weight: np.ndarray, discount: float, seed: np.ndarray) -> np.ndarray:
    """Tables of dishes whose customers sit down one after another; a new table weighs ``weight``, old ones customers - discount * tables."""
    tables = np.ones(len(customers))
    open_dishes = np.flatnonzero(customers > 1)
    at = 1
    while len(open_dishes):
        run = 1 if at < ONE_BY_ONE else at // 16
        run = np.minimum(run, customers[open_dishes] - at)
        new = weight[open_dishes]
        chance = new / (new + at - discount * tables[open_dishes])
        luck = (rolling.mix(seed[open_dishes] + np.uint64(at) * _GOLD) >> np.uint64(11)).astype(float) * 2.0**-53
        tables[open_dishes] += np.floor(run * chance + luck)
        at += 1 if at < ONE_BY_ONE else at // 16
        open_dishes = open_dishes[customers[open_dishes] > at]
    return np.minimum(tables, customers)


def expected(customers: np.ndarray, weight: np.ndarray, discount: float) -> np.ndarray:
    """Mean tables that ``seated`` gives, with the variance of the tables for the curvature of the chance."""
    tables, spread = np.ones(len(customers)), np.zeros(len(customers))
    open_dishes = np.flatnonzero(customers > 1)
    at = 1
    while len(open_dishes):
        run = np.minimum(1 if at < ONE_BY_ONE else at // 16, customers[open_dishes] - at)
        new, t, v = weight[open_dishes], tables[open_dishes], spread[open_dishes]
        all_seats = new + at - discount * t
        chance, bend = new / all_seats, discount / all_seats
        step = run * chance * (1 + bend * bend * v)
        tables[open_dishes] = t + step
        rest = step - np.floor(step)
        spread[open_dishes] = v * (1 + run * chance * bend) ** 2 + rest * (1 - rest)
        at += 1 if at < ONE_BY_ONE else at // 16
        open_dishes = open_dishes[customers[open_dishes] > at]
    return np.minimum(tables, customers)


def _grid(total: np.ndarray) -> np.ndarray:
    """Numbers of tables from 1 to the customers of each context, in equal ratios: GRID columns."""
    return np.maximum(total, 2)[:, None] ** np.linspace(0, 1, GRID)


def _alike(context: np.ndarray, customers: np.ndarray, parent: np.ndarray):
    """Dishes of equal customers and parent in a context, which take equally many tables, once, and how many there are."""
    kinds = np.lexsort((parent, customers, context))
    c, k, p = context[kinds], customers[kinds], parent[kinds]
    first = np.flatnonzero(np.r_[True, (c[1:] != c[:-1]) | (k[1:] != k[:-1]) | (p[1:] != p[:-1])])
    return c[first], k[first], p[first], np.diff(np.r_[first, len(c)])


def tables_at_rest(context: np.ndarray, customers: np.ndarray, parent: np.ndarray, size: int) -> np.ndarray:
    """About the number of tables of whole contexts at which the sampler is at rest: HALVINGS of the range between dishes and customers."""
    low, high = (np.log(np.maximum(np.bincount(context, x, size), 1)) for x in (np.minimum(customers, 1), customers))
    c, k, p, times = _alike(context, customers, parent)
    single = np.bincount(c[k == 1], times[k == 1], size)
    c, k, p, times = (x[k > 1] for x in (c, k, p, times))
    tables = np.ones(len(c))
    for _ in range(HALVINGS):
        middle = (low + high) / 2
        tables = expected(k, (STRENGTH + DISCOUNT * np.maximum(np.exp(middle)[c] - tables, 0)) * p, DISCOUNT)
        more = np.bincount(c, tables * times, size) + single > np.exp(middle)
        low, high = np.where(more, middle, low), np.where(more, high, middle)
    return np.exp((low + high) / 2)


def expected_tables(context: np.ndarray, total: np.ndarray, customers: np.ndarray, parent: np.ndarray) -> np.ndarray:
    """Tables that the given dishes of each context take together, for each number of ``_grid`` that the whole context has."""
    c, k, p, times = _alike(context, customers, parent)
    grid, tables, out = _grid(total), np.ones(len(c)), []
    for column in grid.T:
        for _ in range(2):
            tables = expected(k, (STRENGTH + DISCOUNT * np.maximum(column[c] - tables, 0)) * p, DISCOUNT)
        out.append(np.bincount(c, tables * times, len(total)))
    return np.stack(out, axis=1)


def settled_tables(total: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """The number of tables of each context at which its dishes take as many as there are."""
    x = np.log(_grid(total))
    gap = np.log(np.maximum(sums, 1)) - x
    # One dish takes one table at least, so the first gap is not negative; the last is not positive.
    at = np.clip((gap >= 0).cumprod(axis=1).sum(axis=1) - 1, 0, GRID - 2)
    row = np.arange(len(x))
    g, h = gap[row, at], gap[row, at + 1]
    share = np.clip(g / np.maximum(g - h, 1e-12), 0, 1)
    return np.exp(x[row, at] + share * (x[row, at + 1] - x[row, at]))


def seat_contexts(context: np.ndarray, whole: np.ndarray, customers: np.ndarray, parent: np.ndarray, seed: np.ndarray):
    """Mean tables of every pair (``context`` in order), and the last sample; ``whole``: tables of contexts with other parts, NaN without."""
    size = int(context[-1]) + 1 if len(context) else 0
    tables, mean = np.minimum(customers, 1).astype(float), np.zeros(len(customers))
    start = tables_at_rest(context, customers, parent, size)
    for sweep in range(BURN + SAMPLES):
        others = np.where(np.isnan(whole[:size]), np.bincount(context, tables, size) if sweep else start, whole[:size])
        weight = (STRENGTH + DISCOUNT * np.maximum(others[context] - tables, 0)) * parent
        tables = seated(customers, weight, DISCOUNT, rolling.mix(seed + np.uint64(sweep + 1) * _WORD))
        if sweep >= BURN:
            mean += tables / SAMPLES
    return mean, tables


def _numbers_of(word: np.ndarray, part: np.ndarray) -> np.ndarray:
    """The number of each (word, part) among the sorted distinct ones."""
    order = np.lexsort((part, word))
    w, p = word[order], part[order]
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(np.r_[False, (w[1:] != w[:-1]) | (p[1:] != p[:-1])])
    return out


class Bucket:
    """The pairs of a context bucket: parts of contexts, and the distinct dishes of each with their training customers."""

    def __init__(self, table: pa.Table, train_tokens: int):
        self.heads, self.bodies, self.chunk_of = [], [], table["bucket"].to_pylist()
        for keys, more in zip(table["keys"].to_pylist(), table["more"].to_pylist(), strict=True):
            m, k = len(keys) // 20, len(more) // 13
            self.heads.append([_unplaned(keys[4 * m * i : 4 * m * (i + 1)], m).astype(np.int64) for i in range(5)])
            self.bodies.append([*[_unplaned(more[4 * k * i : 4 * k * (i + 1)], k).astype(np.int64) for i in range(3)], np.frombuffer(more, np.uint8, k, 12 * k)])
        ub, un, part, runs, total = (np.concatenate(x) for x in zip(*self.heads, strict=True))
        wb, wn, times, frequency = (np.concatenate(x) for x in zip(*self.bodies, strict=True))
        self.context = context = _numbers_of((ub << 32) | un, part)
        self.size = size = int(context.max()) + 1
        self.total, self.word, names = np.zeros(size, np.int64), np.zeros(size, np.int64), np.zeros(size, np.uint64)
        self.total[context] = total
        self.word[context] = (ub << 32) | un
        names[context] = ((ub << 32) | un).astype(np.uint64) + part.astype(np.uint64) * _PART
        of = np.repeat(context, runs)
        dish = (wb << 32) | wn
        order = np.lexsort((dish, of))
        new = np.r_[True, (of[order][1:] != of[order][:-1]) | (dish[order][1:] != dish[order][:-1])] if len(order) else np.zeros(0, bool)
        first = np.flatnonzero(new)
        self.customers = np.add.reduceat(times[order], first) if len(first) else np.zeros(0, np.int64)
        self.pair = np.empty(len(order), np.int64)
        self.pair[order] = np.cumsum(new) - 1
        self.some = self.customers > 0
        at = order[first]
        self.of, self.dish = of[at], dish[at]
        self.seed = rolling.mix(names[self.of] * _GOLD + self.dish.astype(np.uint64))
        self.parent = 2.0 ** (frequency[at] / 8) / max(train_tokens, 1)


def _expect(train_tokens: int, hot: int):
    """Expected tables of the parts of split contexts, to the word bucket of the context."""

    def expect(table: pa.Table) -> pa.Table:
        if not any((_unplaned(k[len(k) // 5 * 4 :], len(k) // 20) >= hot).any() for k in table["keys"].to_pylist()):
            return _messages([])
        data = Bucket(table, train_tokens)
        mine = data.some & (data.total[data.of] >= hot)
        if not mine.any():
            return _messages([])
        there, context = np.unique(data.of[mine], return_inverse=True)
        sums = expected_tables(context, data.total[there], data.customers[mine], data.parent[mine])
        # Several parts may lie in one bucket.
        words, place = np.unique(data.word[there], return_inverse=True)
        joined, total = np.zeros((len(words), GRID)), np.zeros(len(words), np.int64)
        np.add.at(joined, place, sums)
        total[place] = data.total[there]
        me = table["target"][0].as_py()
        return _messages([
            (SETTLED, int(w >> 32), me, (w & 0xFFFFFFFF).astype("<u4").tobytes() + t.astype("<i8").tobytes(), g.astype("<f8").tobytes())
            for w, t, g in zip(words, total, joined, strict=True)
        ])

    return expect


def _settle(table: pa.Table) -> pa.Table:
    """The tables of each split context, to the buckets of its parts."""
    keys, place = np.unique(np.array(table["keys"].to_pylist(), object), return_inverse=True)
    sums = np.zeros((len(keys), GRID))
    for k, more in zip(place.tolist(), table["more"].to_pylist(), strict=True):
        sums[k] += np.frombuffer(more, "<f8")
    total = np.array([np.frombuffer(k, "<i8", 1, 4)[0] for k in keys])
    whole = settled_tables(total, sums)
    bucket = table["target"][0].as_py()
    return _messages([
        (SETTLED, b, bucket, keys[k][:4], b"", float(whole[k])) for b, k in zip(table["bucket"].to_pylist(), place.tolist(), strict=True)
    ])


def _seat(kinds: tuple[int, ...], train_tokens: int):
    """Answers of a context bucket: pairs back to chunks, or tables on to the word buckets of their dishes and of their contexts."""

    def seat(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _messages([])
        data = Bucket(table, train_tokens)
        some, of, pair, size = data.some, data.of, data.pair, data.size
        known = {(b << 32) | int(_unplaned(k, 1)[0]): t for b, k, t in zip(*(answers[x].to_pylist() for x in ("bucket", "keys", "s1")), strict=True)}
        whole = np.array([known.get(w, np.nan) for w in data.word.tolist()]) if known else np.full(size, np.nan)
        customers = data.customers
        mean, last = seat_contexts(of[some], whole, customers[some], data.parent[some], data.seed[some])
        rows = []
        if PAIRS_BACK in kinds:
            kept = np.zeros(len(customers))
            kept[some] = (customers[some] - DISCOUNT * mean) / (STRENGTH + data.total[of[some]])
            q = 0
            for c, body in zip(data.chunk_of, data.bodies, strict=True):
                k = len(body[0])
                rows.append((PAIRS_BACK, c, table["target"][0].as_py(), b"", _planes(kept[pair[q : q + k]], "<f4")))
                q += k
        if TABLES_ON in kinds and some.any():
            for kind, words, tables, layout in ((TABLES_ON, data.dish[some], last, "<u4"), (CONTEXTS_ON, data.word[of[some]], mean, "<f4")):
                words, place = np.unique(words, return_inverse=True)
                sums = np.bincount(place, tables)
                bucket = words >> 32
                edges = _runs_of(bucket)
                for a, z in zip(edges, np.r_[edges[1:], len(words)], strict=True):
                    rows.append((kind, -1 - int(bucket[a]), 0, _planes(words[a:z] & 0xFFFFFFFF), _planes(sums[a:z], layout)))
        return _messages(rows)

    return seat


def _runs_of(ordered: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])


def _seat_words(table: pa.Table, tables: pa.Table) -> pa.Table:
    """The parent restaurant's dishes of a word bucket: each chunk gets the count of its words, their
    discounted customers, and the tables of the contexts that they are."""
    if not table.num_rows:
        return _messages([])
    numbers, count, values, size = _numbered(table)
    customers, below = np.zeros(size + 1, np.int64), np.zeros(size + 1)
    for kind, keys, more in zip(*(tables[x].to_pylist() for x in ("kind", "keys", "more")), strict=True):
        k = len(keys) // 4
        word = _unplaned(keys, k).astype(np.int64) - 1
        if kind == TABLES_ON:
            # A message names a word once.
            customers[word] += _unplaned(more, k).astype(np.int64)
        else:
            below[word] += _unplaned(more, k, "<f4").astype(float)
    customers = customers[:size]
    mean, t = np.zeros(size), np.minimum(customers, 1).astype(float)
    for sweep in range(BURN + SAMPLES):
        # The share of the uniform parent is the same in every bucket, as words are dealt by chance.
        weight = np.full(size, PARENT_DISCOUNT * t.sum() / max(size, 1))
        t = np.where(customers > 0, seated(customers, weight, PARENT_DISCOUNT, rolling.mix(values + np.uint64(sweep + 1) * _WORD)), 0)
        if sweep >= BURN:
            mean += t
    left = np.r_[customers - PARENT_DISCOUNT * mean / SAMPLES, 0.0]
    padded = np.r_[count, 0]
    bucket = -1 - table["target"][0].as_py()
    rows = [
        (WORDS_BACK, c, bucket, _planes(padded[x]), _planes(left[x], "<f4") + _planes(below[x], "<f4")) for c, x in zip(table["bucket"].to_pylist(), numbers, strict=True)
    ]
    return _messages([*rows, (TOTALS, -1, bucket, b"", b"", float(customers.sum()), float(mean.sum()), float(size))])


def _score(n: int, hot: int, train_tokens: int):
    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        kind = pa.schema([
            ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
            ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
        ])
        if not table.num_rows:
            return kind.empty_table()
        chunk = Chunk(table)
        by_kind = {k: answers.filter(pc.equal(answers["kind"], k)).sort_by("bucket") for k in (PAIRS_BACK, WORDS_BACK, TOTALS)}
        totals = by_kind[TOTALS]
        customers, tables, types = (float(np.sum(totals[s].to_numpy())) for s in ("s1", "s2", "s3"))
        sizes = np.diff(np.searchsorted(rolling.bucket_of(chunk.distinct, n), np.arange(n + 1)))
        words = by_kind[WORDS_BACK]
        packed = list(zip(words["keys"].to_pylist(), words["more"].to_pylist(), sizes[sizes > 0], strict=True))
        count = np.concatenate([_unplaned(k, s) for k, _, s in packed]).astype(np.int64)
        left, below = (np.concatenate([_unplaned(m[4 * s * i : 4 * s * (i + 1)], s, "<f4") for _, m, s in packed]).astype(float) for i in range(2))
        spread = (PARENT_STRENGTH + PARENT_DISCOUNT * tables / SAMPLES) / (types + 1)
        single = (left + spread) / (PARENT_STRENGTH + customers)
        chance = single[chunk.token]
        _, _, of_token = _pairs(chunk, count > 0, count, n, hot)
        kept = [np.zeros(0), *(_unplaned(m, len(m) // 4, "<f4") for m in by_kind[PAIRS_BACK]["more"].to_pylist())]
        back = np.where(count > 0, (STRENGTH + DISCOUNT * below) / (STRENGTH + count), 1.0)
        chance = chance * back[chunk.before] + np.where(of_token >= 0, np.r_[np.concatenate(kept), 0.0][of_token], 0.0)
        base = np.log10((count[chunk.token] + 1) / (train_tokens + types + 1))
        n_docs = len(chunk.counts)
        return pa.table({
            "doc_id": chunk.ids.cast(pa.int64()), "held_out": pa.array(chunk.held), "n_tokens": pa.array(chunk.counts, pa.int64()),
            "n_known": pa.array(np.bincount(chunk.doc, count[chunk.token] > 0, n_docs).astype(np.int64)),
            "train_tokens": pa.array(np.full(n_docs, train_tokens), pa.int64()),
            "base_score": pa.array(np.bincount(chunk.doc, base, n_docs)), "score": pa.array(np.bincount(chunk.doc, np.log10(chance), n_docs)),
        }, schema=kind)

    return score


def scores(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES, bucket_bytes: int = BUCKET_BYTES, hot: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10 probability) of every document."""
    size = docs.select(
        F.sum(F.octet_length("text")), F.sum(F.when(~held_out("doc_id"), F.size(word_array("text")) + 1))
    ).first()
    total, train_tokens = size[0] or 0, size[1] or 0
    n_chunks, n = max(1, -(-total // chunk_bytes)), max(1, -(-total // bucket_bytes))
    hot = hot or max(50_000, train_tokens // (2 * n))
    texts = docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_chunks)).cast("int").alias("chunk"), "doc_id", "text", held_out("doc_id").alias("held")
    ).groupBy("chunk")
    words = texts.applyInArrow(_send_words(n), MESSAGE)
    numbers = words.groupBy("target").applyInArrow(_number_words, MESSAGE)
    pairs = texts.cogroup(numbers.groupBy("target")).applyInArrow(_send_pairs(n, hot), MESSAGE).groupBy("target")
    whole = pairs.applyInArrow(_expect(train_tokens, hot), MESSAGE).groupBy("target").applyInArrow(_settle, MESSAGE).groupBy("target")
    back = pairs.cogroup(whole).applyInArrow(_seat((PAIRS_BACK,), train_tokens), MESSAGE)
    on = pairs.cogroup(whole).applyInArrow(_seat((TABLES_ON,), train_tokens), MESSAGE)
    parent = words.groupBy("target").cogroup(on.groupBy("target")).applyInArrow(_seat_words, MESSAGE)
    totals = parent.where(F.col("kind") == TOTALS).agg(*[F.sum(s).alias(s) for s in ("s1", "s2", "s3")])
    none = F.lit(b"").cast("binary")
    totals = totals.select(
        F.lit(TOTALS).alias("kind"), F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("target"), F.lit(0).alias("bucket"),
        none.alias("keys"), none.alias("more"), "s1", "s2", "s3",
    )
    answers = back.unionByName(parent.where(F.col("kind") == WORDS_BACK)).unionByName(totals)
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return texts.cogroup(answers.groupBy("target")).applyInArrow(_score(n, hot, train_tokens), schema)
