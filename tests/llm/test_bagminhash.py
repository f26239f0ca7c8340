"""Near-duplicate classes against all pairs, and signatures against the exact similarity."""

import random
from collections import Counter

import numpy as np
import pytest

from grainmill.llm import bagminhash, rolling
from grainmill.llm.components import components

SCHEMA = "doc_id long, text string, label string"


def bag(text):
    words = (text or "").encode().split()
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def similarity(a, b):
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 0.0


def brute(rows):
    ids = sorted({r[0] for r in rows if r[0] is not None})
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    bags = [(r[0], bag(r[1])) for r in rows if r[0] is not None]
    for x, (i, a) in enumerate(bags):
        for j, b in bags[x + 1 :]:
            if similarity(a, b) >= 0.8:
                p, q = root(i), root(j)
                parent[max(p, q)] = min(p, q)
    return {i: root(i) for i in ids}


def classes(spark, rows):
    return {r.doc_id: r.class_id for r in bagminhash.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_estimate_is_weighted_jaccard():
    rnd = random.Random(5)
    base = [f"w{rnd.randrange(60)}" for _ in range(400)] + ["x y z u v"] * 9
    texts = [" ".join(base), " ".join(base[60:] + ["q"] * 20), " ".join(base + ["x y z u v"] * 40)]
    doc, value, weight, _ = bagminhash.shingles(rolling.words([t.encode() for t in texts]))
    assert weight.max() > 30
    # 40 keys for the shingles give 40 independent signatures.
    runs = [bagminhash.signatures(doc, rolling.mix(value + np.uint64(k)), weight, 3) for k in range(40)]
    for i, j in ((0, 1), (0, 2), (1, 2)):
        agree = np.mean([(r[i] == r[j]).mean() for r in runs])
        assert abs(agree - similarity(bag(texts[i]), bag(texts[j]))) < 0.03


@pytest.mark.parametrize("seed", range(2))
def test_random_copies(spark, seed):
    rnd = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(300)]
    originals = [[rnd.choice(vocabulary) for _ in range(rnd.choice([6, 40, 120, 300]))] for _ in range(25)]
    rows = []
    for doc_id in range(160):
        words = list(rnd.choice(originals))
        for _ in range(rnd.choice([0, 0, 1, 2, 3, 8])):
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        rows.append((doc_id * 3 + 1, " ".join(words), "x"))
    assert classes(spark, rows) == brute(rows)


def test_chain_beyond_the_smallest_node(spark):
    """A chain of small changes: neighbours are alike, the ends are not, so most pairs with the smallest node fail."""
    rnd = random.Random(1)
    words = [f"c{i}" for i in range(200)]
    rows = []
    for doc_id in range(30):
        rows.append((doc_id, " ".join(words), None))
        for _ in range(3):
            words[rnd.randrange(200)] = f"n{doc_id}{rnd.random()}"
    assert classes(spark, rows) == brute(rows)


def test_odd_rows(spark):
    long = " ".join(f"v{i % 9973}" for i in range(60_000))
    rows = [(1, None, "a"), (2, "", "a"), (3, "one two", None), (4, "one  two", "b"), (5, "one", "b"), (6, long, "c"), (7, long + " end", "c"), (7, long + " end", "c")]
    assert classes(spark, rows) == {1: 1, 2: 2, 3: 3, 4: 3, 5: 5, 6: 6, 7: 6}
    assert classes(spark, [(None, "a b c d e f", "x"), (1, "a b c d e f", "x")]) == {None: None, 1: 1}
    assert classes(spark, []) == {}
    left = bagminhash.one_of_each(spark.createDataFrame(rows, SCHEMA))
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 3, 5, 6] and left.columns == ["doc_id", "text", "label"]


def test_one_of_each_with_repeated_and_missing_ids(spark):
    text = lambda c: " ".join(f"{c}{i}" for i in range(30))
    rows = [(5, text("a"), "x"), (5, text("b"), "x"), (5, text("b"), "y"), (2, text("b") + " end", "x"), (None, text("c"), "x"), (None, text("c"), "y")]
    rows += [(None, text("d"), "x"), (9, text("d"), "x"), (None, None, "x"), (7, "", "x")]
    left = bagminhash.one_of_each(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(((r.doc_id, r.text) for r in left), key=str) == sorted(
        [(5, text("a")), (2, text("b") + " end"), (None, text("c")), (9, text("d")), (None, None), (7, "")], key=str
    )


def test_large_buckets_are_split(spark, monkeypatch):
    rnd = random.Random(3)
    common = [f"k{i}" for i in range(120)]
    rows = [(i, " ".join(common + [f"o{i}-{j}" for j in range(rnd.choice([20, 40, 60]))]), "x") for i in range(40)]
    rows += [(i + 100, rows[i][1] + " tail", "x") for i in range(0, 40, 3)]
    monkeypatch.setattr(bagminhash.unsettled, "__defaults__", (5,))
    assert classes(spark, rows) == brute(rows)


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (100, 102)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in (100, 101, 102)}
