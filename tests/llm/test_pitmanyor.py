"""Pitman-Yor scores: exact base, a plain sampler, and the split of hot contexts."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from grainmill.llm import pitmanyor, rolling

SCHEMA = "doc_id long, text string, score string"


def held(i):
    return zlib.crc32(str("" if i is None else i).encode()) % 7 == 2


def tokens(text):
    fold = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
    return [*(text or "").encode().translate(fold).split(), None]


def scores(spark, rows, **sizes):
    frame = spark.createDataFrame(rows, SCHEMA)
    return {r.doc_id: r for r in pitmanyor.scores(frame, **sizes).collect()}


def plain(rows, seed=1):
    """A straightforward sampler with the same customers; probabilities averaged over many samples."""
    rnd = random.Random(seed)
    pairs, words = defaultdict(Counter), Counter()
    for i, text, _ in rows:
        if not held(i):
            before = None
            for w in tokens(text):
                pairs[before][w] += 1
                words[w] += 1
                before = w
    n, v, d, s = sum(words.values()), len(words), pitmanyor.DISCOUNT, pitmanyor.STRENGTH

    def sit(c, weight, discount):
        t = 1
        for at in range(1, c):
            t += rnd.random() < weight / (weight + at - discount * t)
        return t

    tables = {u: {w: 1 for w in ws} for u, ws in pairs.items()}
    mean = defaultdict(float)
    for _ in range(60):
        for u, ws in pairs.items():
            for w, c in ws.items():
                others = sum(tables[u].values()) - tables[u][w]
                tables[u][w] = sit(c, (s + d * others) * words[w] / n, d)
                mean[u, w] += tables[u][w] / 60
    dishes = Counter()
    for (_, w), t in mean.items():
        dishes[w] += t
    t1 = {w: np.mean([sit(round(c), pitmanyor.PARENT_DISCOUNT * 1.3, pitmanyor.PARENT_DISCOUNT) for _ in range(30)]) for w, c in dishes.items()}
    top, e = pitmanyor.PARENT_STRENGTH, pitmanyor.PARENT_DISCOUNT

    def single(w):
        spread = (top + e * sum(t1.values())) / (v + 1)
        return ((dishes[w] - e * t1[w] if w in dishes else 0) + spread) / (top + sum(dishes.values()))

    def score(text):
        total, before = 0.0, None
        for w in tokens(text):
            p = single(w)
            if before in pairs:
                c = sum(pairs[before].values())
                back = (s + d * sum(mean[before, x] for x in pairs[before])) / (s + c)
                p = p * back + ((pairs[before][w] - d * mean[before, w]) / (s + c) if w in pairs[before] else 0)
            total += math.log10(p)
            before = w
        return total

    base = lambda text: sum(math.log10((words[w] + 1) / (n + v + 1)) for w in tokens(text))
    return score, base, words, n


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(2)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "The", "the"]
    follow = {w: rnd.sample(vocabulary, 4) for w in vocabulary}
    out = []
    for i in range(200):
        words = [rnd.choice(vocabulary)]
        for _ in range(rnd.randrange(30)):
            words.append(rnd.choice(follow.get(words[-1], vocabulary)) if rnd.random() < 0.8 else rnd.choice(vocabulary + [f"rare{i}"]))
        out.append((i, " ".join(words), None))
    return out


def test_against_a_plain_sampler(spark, rows):
    got = scores(spark, rows, chunk_bytes=3000, bucket_bytes=4000)
    score, base, words, n = plain(rows)
    assert len(got) == len(rows)
    better, gaps = 0, []
    for i, text, _ in rows:
        r, ts = got[i], tokens(text)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(ts), sum(t in words for t in ts), n)
        assert abs(r.base_score - base(text)) < 1e-9 * max(1, len(ts))
        # Three samples here, sixty there: single words may differ, texts on the whole do not.
        gaps.append((r.score - score(text)) / len(ts))
        assert abs(gaps[-1]) < 0.2, (i, r.score, score(text))
        better += r.held_out and r.score > r.base_score
    assert abs(np.mean(gaps)) < 0.01 and np.mean(np.abs(gaps)) < 0.04, (np.mean(gaps), np.mean(np.abs(gaps)))
    assert better > 0.8 * sum(r.held_out for r in got.values())


def test_hot_contexts_are_split(spark, rows):
    whole, split = scores(spark, rows), scores(spark, rows, chunk_bytes=5000, bucket_bytes=2000, hot=20)
    for i, text, _ in rows:
        assert abs(whole[i].score - split[i].score) < 0.2 * whole[i].n_tokens


def test_odd_rows(spark):
    long = " ".join(f"v{i % 91}" for i in range(30_000))
    rows = [(0, None, "a"), (1, "", None), (2, "a  b\tA\n", "x"), (2, "a  b\tA\n", "x"), (None, "a b", "y"), (3, long, "z")]
    got = scores(spark, rows)
    score, base, _, n = plain(rows)
    for i, text, _ in rows:
        assert got[i].train_tokens == n and abs(got[i].base_score - base(text)) < 1e-6 and math.isfinite(got[i].score)
    assert scores(spark, []) == {}
    only_held = next(i for i in range(100) if held(i))
    assert scores(spark, [(only_held, "a b", "x")])[only_held].n_known == 0


def test_runs_of_seats_match_single_seats():
    customers = np.full(4000, 3000)
    runs = pitmanyor.seated(customers, np.full(4000, 2.0), 0.5, np.arange(4000, dtype=np.uint64))
    try:
        pitmanyor.ONE_BY_ONE, kept = 10_000, pitmanyor.ONE_BY_ONE
        single = pitmanyor.seated(customers, np.full(4000, 2.0), 0.5, np.arange(4000, dtype=np.uint64))
    finally:
        pitmanyor.ONE_BY_ONE = kept
    assert abs(runs.mean() / single.mean() - 1) < 0.02


def test_parts_of_a_skewed_context_agree_on_its_tables():
    """One heavy dish and many light ones in 30 parts: tables as in the unsplit context, run until they stand still."""
    rnd = np.random.default_rng(4)
    customers = np.r_[60_000, rnd.zipf(1.6, 8000).clip(1, 3000)].astype(np.int64)
    parent = customers / customers.sum() * 0.4
    total, part = np.array([customers.sum()]), np.arange(len(customers)) % 30
    seed, one = np.arange(len(customers), dtype=np.uint64), np.zeros(len(customers), np.int64)
    kept, pitmanyor.BURN = pitmanyor.BURN, 12
    try:
        still, _ = pitmanyor.seat_contexts(one, np.array([np.nan]), customers, parent, seed)
    finally:
        pitmanyor.BURN = kept
    sums = sum(pitmanyor.expected_tables(one[part == k], total, customers[part == k], parent[part == k]) for k in range(30))
    whole = pitmanyor.settled_tables(total, sums)
    assert abs(whole[0] / still.sum() - 1) < 0.01
    parts = [pitmanyor.seat_contexts(one[part == k], whole, customers[part == k], parent[part == k], seed[part == k])[0] for k in range(30)]
    assert abs(sum(p.sum() for p in parts) / still.sum() - 1) < 0.01


def test_split_contexts_score_like_the_plain_sampler(spark):
    """Half of the followers of one word are one dish, the others are many: split by dishes, scores stay those of the plain sampler."""
    rnd = random.Random(7)
    rows = [(i, " ".join(x for _ in range(12) for x in ("the", "big" if rnd.random() < 0.5 else f"w{rnd.randrange(400)}")), None) for i in range(300)]
    score, *_ = plain(rows)
    got = scores(spark, rows, chunk_bytes=5000, bucket_bytes=3000, hot=100)
    gaps = [(got[i].score - score(text)) / got[i].n_tokens for i, text, _ in rows]
    assert abs(np.mean(gaps)) < 0.01 and np.mean(np.abs(gaps)) < 0.04, (np.mean(gaps), np.mean(np.abs(gaps)))


def test_large_contexts_are_sampled_at_rest():
    """A context of three million customers: the averaged sweeps are not those in which its tables still grow."""
    rnd = np.random.default_rng(5)
    customers = rnd.zipf(1.3, 60_000).clip(1, 20_000).astype(np.int64)
    customers = np.r_[customers, np.full(3000, 1 + max(0, 3_000_000 - customers.sum()) // 3000)]
    parent, one = np.full(len(customers), 1 / len(customers)), np.zeros(len(customers), np.int64)
    seed = np.arange(len(customers), dtype=np.uint64)
    mean, _ = pitmanyor.seat_contexts(one, np.array([np.nan]), customers, parent, seed)
    kept, pitmanyor.BURN = pitmanyor.BURN, 25
    try:
        still, _ = pitmanyor.seat_contexts(one, np.array([np.nan]), customers, parent, seed)
    finally:
        pitmanyor.BURN = kept
    assert abs(mean.sum() / still.sum() - 1) < 0.02, (mean.sum(), still.sum())


def sent(texts, corpus, n, hot):
    """Messages of one chunk to the context buckets of a corpus that holds its texts ``corpus`` times."""
    table = pa.table({"chunk": [0] * len(texts), "doc_id": [*range(len(texts))], "text": texts, "held": [False] * len(texts)})
    chunk = pitmanyor.Chunk(table)
    count, bucket = corpus * np.bincount(chunk.token), rolling.bucket_of(chunk.distinct, n)
    answers = []
    for b in range(n):
        mine = np.flatnonzero(bucket == b)
        if len(mine):
            answers.append((0, 0, b, pitmanyor._planes(np.arange(1, len(mine) + 1)), pitmanyor._planes(count[mine])))
    return pitmanyor._send_pairs(n, hot)(table, pitmanyor._messages(answers)).to_pylist()


def test_what_a_chunk_sends_does_not_grow_with_the_corpus():
    """Four and sixteen times the corpus have as many times the buckets and parts; a chunk has the same pairs."""
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(500)]
    texts = [" ".join(rnd.choices(words, [1 / (i + 1) for i in range(500)], k=200)) for _ in range(30)]
    size = {}
    for times in (1, 4, 16):
        rows = sent(texts, 100 * times, 8 * times, 50)
        parts = [np.concatenate([pitmanyor._unplaned(r["keys"][len(r["keys"]) // 5 * k :], len(r["keys"]) // 20) for r in rows]) for k in (3, 4)]
        pairs = sum(len(r["more"]) // 13 for r in rows)
        assert parts[0].min() >= 1 and parts[0].sum() == pairs
        size[times] = sum(len(r["keys"]) + len(r["more"]) for r in rows)
        assert size[times] <= pairs * (20 + 13)
    # More parts hold single pairs; once all do, nothing grows.
    assert size[16] <= 1.05 * size[4] <= 1.2 * size[1]


def test_many_chunks_and_buckets_score_like_the_plain_sampler(spark, rows):
    """A few texts a chunk: most contexts that a chunk backs off from hold none of its pairs in most of their parts."""
    score, *_ = plain(rows)
    got = scores(spark, rows, chunk_bytes=300, bucket_bytes=150, hot=5)
    gaps = [(got[i].score - score(text)) / got[i].n_tokens for i, text, _ in rows]
    assert abs(np.mean(gaps)) < 0.01 and np.mean(np.abs(gaps)) < 0.04, (np.mean(gaps), np.mean(np.abs(gaps)))


def test_contexts_are_numbered_as_sorted_pairs():
    rng = np.random.default_rng(5)
    word, part = rng.integers(0, 40, 3000) << 31, rng.integers(0, 5, 3000)
    want = np.unique(np.stack([word, part]), axis=1, return_inverse=True)[1].reshape(-1)
    assert np.array_equal(pitmanyor._numbers_of(word, part), want)
    assert pitmanyor._numbers_of(word[:1], part[:1]).tolist() == [0]
