"""Held-out accuracy of the grades, recall of the latent search, and their odd rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from grainmill.llm import decontaminate, ordinal

DOCS = "doc_id long, text string, hits string, row string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "h", "r") for i, t in rows], DOCS)


@pytest.fixture(scope="module")
def prose():
    rnd = random.Random(8)
    parts = ["an", "bel", "cor", "du", "est", "fla", "gro", "hin", "ist", "jor"]
    vocabulary = ["".join(rnd.choice(parts) for _ in range(rnd.choice([1, 2, 3, 4]))) for _ in range(3000)]
    return lambda n: [rnd.choice(vocabulary[:40]) if rnd.random() < 0.5 else rnd.choice(vocabulary) for _ in range(n)]


def test_grades_on_held_out_documents(spark, prose):
    rnd = random.Random(3)
    docs, labels = [], []
    for i in range(1500):
        words, kind = prose(rnd.choice([30, 120, 400])), rnd.choice(["good"] * 6 + ["toxic", "poor"])
        if kind == "toxic":
            for _ in range(4):
                words[rnd.randrange(len(words))] = rnd.choice(["Scum,", "loser", "TRASH", "idiot."])
        if kind == "poor":
            words = [w + "###" for w in words]
        docs.append((i, " ".join(words)))
        if i % 3:
            labels.append((i, int(kind != "poor"), int(kind == "toxic")))
        else:
            docs[-1] = (i, docs[-1][1] + f" kind-{kind}"[:0])
            labels.append((-i - 1, {"good": 1, "toxic": 1, "poor": 0}[kind], int(kind == "toxic")))
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = ordinal.train(frame(spark, docs), table)
    truth = {-i - 1: (q, t) for i, q, t in labels if i < 0}
    held = [r for r in ordinal.graded(frame(spark, docs), model).collect() if r.doc_id in truth]
    right = sum(r.kept == (truth[r.doc_id] == (1, 0)) for r in held)
    assert right > 0.97 * len(held) == 0.97 * 500
    grade = lambda want: [r.expected_grade for r in held if truth[r.doc_id] == want]
    mean = lambda x: sum(x) / len(x)
    assert mean(grade((1, 1))) < mean(grade((0, 0))) < mean(grade((1, 0)))
    assert (model.thresholds[1:] >= model.thresholds[:-1]).all()


def test_grades_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "x" * 200_000), (3, "a"), (4, "word " * 60_000)]
    labels = spark.createDataFrame([(1, 1, None), (2, None, 1), (4, 0, 0), (4, 1, 0), (99, 1, 0)], "doc_id long, quality int, toxic int")
    docs = frame(spark, rows)
    got = ordinal.graded(docs, ordinal.train(docs, labels)).collect()
    assert len(got) == len(rows) and all(0 <= r.tail_probability <= 1 and 0 <= r.expected_grade <= 2 for r in got)
    assert ordinal.train(docs, labels.limit(0)) is None
    assert {(r.expected_grade, r.kept) for r in ordinal.graded(docs, None).collect()} == {(None, True)}
    assert ordinal.graded(frame(spark, []), None).count() == 0


def test_leaks(spark, prose):
    rnd = random.Random(5)
    items = [prose(rnd.choice([12, 25, 45, 70, 130])) for _ in range(30)] + [["só", "short"]]
    docs, want = [], {}
    for i in range(240):
        words = prose(rnd.choice([40, 200, 700]))
        want[i] = set()
        if i % 3 == 0:
            k = rnd.randrange(len(items))
            piece = [w for w in items[k] if i % 2 or len(items[k]) < 9 or rnd.random() > 0.1]
            at = rnd.randrange(len(words))
            words[at:at] = [w.upper() + "," if i % 2 else w for w in piece]
            want[i].add(k)
        docs.append((i, " ".join(words)))
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)] + [(77, None), (78, "?!")], "item_id long, text string")
    got = {r.doc_id: {h.item_id for h in r.hits} for r in decontaminate.benchmark_hits(frame(spark, docs), bench).collect()}
    planted = [i for i in want if want[i]]
    exact = [i for i in planted if i % 2]
    assert all(want[i] <= got[i] for i in exact)
    assert sum(want[i] <= got[i] for i in planted) >= 0.9 * len(planted)
    assert all(not got[i] for i in want if not want[i])
    blocks = {r.doc_id: {h.item_id for h in r.hits} for r in decontaminate.benchmark_hits(frame(spark, docs), bench, block_items=12).collect()}
    assert all(want[i] <= blocks[i] for i in exact) and all(not blocks[i] for i in want if not want[i])
    left = decontaminate.clean_documents(frame(spark, docs), bench)
    assert left.columns == ["doc_id", "text", "hits", "row"] and left.count() == sum(not g for g in got.values())


def test_recall_of_reworded_items(spark, prose):
    """A tenth of the words dropped and a tenth replaced: what the word rule admits is found, at every length; exact items aside."""
    rnd = random.Random(8)
    lengths = ((8, 11), (12, 20), (21, 60), (61, 130))
    items, docs, admitted = [], [], {g: [] for g in lengths}
    for g in lengths:
        for _ in range(60):
            item = prose(rnd.randint(*g))
            changed = [rnd.choice(item) if x < 0.2 else w for w in item if (x := rnd.random()) >= 0.1]
            words = prose(rnd.choice([60, 150, 400]))
            at = rnd.randrange(len(words))
            words[at:at] = changed
            if changed != item and decontaminate.common_subsequence(item, changed) >= decontaminate.SURE * len(item):
                admitted[g].append(len(items))
            items.append((len(items), " ".join(item)))
            docs.append((len(docs), " ".join(words)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.benchmark_hits(frame(spark, docs), bench).collect()
    got = {r.doc_id: {h.item_id for h in r.hits} for r in rows}
    for g, planted in admitted.items():
        assert len(planted) >= 25 and sum(k in got[k] for k in planted) >= 0.9 * len(planted), g
    # Nothing else is drawn from the layout of rows.
    again = decontaminate.benchmark_hits(frame(spark, docs[::-1]).repartition(3), bench, fit_passages=200)
    other = decontaminate.benchmark_hits(frame(spark, docs).coalesce(1), bench, fit_passages=200)
    hits = lambda df: {r.doc_id: {h.item_id for h in r.hits} for r in df.collect()}
    assert hits(again) == hits(other)


def test_sample_is_by_content(spark, prose):
    docs = frame(spark, [(i, " ".join(prose(100 + i))) for i in range(60)] + [(60 + i, "the same text " * 40) for i in range(60)])
    items = decontaminate.Items.of([{"item_id": 1, "text": " ".join(prose(400))}])
    counted = lambda df: df.select("text").mapInArrow(decontaminate._counter(items, 0.5), "term int, n long, passage binary")
    counts = lambda df: sorted(map(tuple, counted(df).where("term > -2").groupBy("term").agg(F.sum("n")).collect()))
    sample = lambda df: {(r.n, bytes(r.passage)) for r in counted(df).where("term = -2").collect()}
    one, many = docs.coalesce(1), docs.orderBy(F.desc("doc_id")).repartition(7)
    assert counts(one) == counts(many) and sample(one) == sample(many) and len(sample(one)) > 50


def test_leaks_of_odd_rows(spark):
    item = " ".join(f"q{i}" for i in range(20))
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, None), (2, ""), (None, item), (3, "w " * 50_000 + item), (3, "w"), (4, "x" * 100_000)]
    got = sorted((str(r.doc_id), len(r.hits)) for r in decontaminate.benchmark_hits(frame(spark, rows), bench).collect())
    assert got == sorted([("1", 0), ("2", 0), ("None", 1), ("3", 1), ("3", 0), ("4", 0)])
    assert decontaminate.benchmark_hits(frame(spark, rows), bench.limit(0)).where("size(hits) > 0").count() == 0
    assert decontaminate.benchmark_hits(frame(spark, []), bench).count() == 0


def test_exact_copies_of_short_items(spark, prose):
    """Items of 1 to 13 common words among rarer words of other items: their cosine with the passage is small."""
    rnd = random.Random(11)
    common = sorted(set(prose(400)), key=len)[:60]
    items = [[rnd.choice(common) for _ in range(n)] for n in [*range(1, 14)] * 4] + [prose(100)[::2] for _ in range(60)]
    rare = sorted({w for item in items[52:] for w in item} - set(common))
    docs = [["start", *rnd.choices(rare, k=rnd.randrange(20, 60)), *items[k % 52], *rnd.choices(rare, k=40)] for k in range(156)]
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    rows = frame(spark, [(k, " ".join(w)) for k, w in enumerate(docs)])
    got = {r.doc_id: {h.item_id: h.share for h in r.hits} for r in decontaminate.benchmark_hits(rows, bench).collect()}
    for k, words in enumerate(docs):
        for i, item in enumerate(items):
            holds = f" {' '.join(item)} " in f" {' '.join(words)} "
            assert got[k].get(i) == 1 if holds else len(item) >= 8 or i not in got[k], (k, item)


def test_fit_climbs_the_plain_likelihood():
    """Weights and thresholds from gradients of the cumulative-link likelihood taken by differences, text by text."""
    rnd = random.Random(4)
    texts = [[rnd.randrange(3) + 3 * g if rnd.random() < 0.7 else 9 + rnd.randrange(4) for _ in range(4)] for g in (0, 1, 2) * 12]
    texts = [sorted(set(t)) for t in texts]
    grades = [0, 1, 2] * 12

    def likelihood(weights, cuts):
        total = 0.0
        for t, g in zip(texts, grades, strict=True):
            below = [0.0, *(1 / (1 + math.exp(sum(weights[f] for f in t) - c)) for c in cuts), 1.0]
            total += math.log(below[g + 1] - below[g])
        return total / len(texts)

    def slope(f, at, k, h=1e-5):
        up, down = list(at), list(at)
        up[k] += h
        down[k] -= h
        return (f(up) - f(down)) / (2 * h)

    shares = [(1 + 12 * (k + 1) + k) / (36 + 3) for k in range(2)]
    weights, seen, cuts, cut_seen = [0.0] * 13, [1e-8] * 13, [math.log(x / (1 - x)) for x in shares], [1e-8] * 2
    for _ in range(ordinal.STEPS):
        g = [slope(lambda w: likelihood(w, cuts), weights, k) for k in range(13)]
        h = [slope(lambda c: likelihood(weights, c), cuts, k) for k in range(2)]
        for k in range(13):
            seen[k] += g[k] ** 2
            step = ordinal.RATE / math.sqrt(seen[k])
            moved = weights[k] + step * g[k]
            weights[k] = math.copysign(max(abs(moved) - step * ordinal.L1, 0), moved)
        cut_seen = [a + b * b for a, b in zip(cut_seen, h, strict=True)]
        cuts = [c + 0.1 * b / math.sqrt(a) for c, a, b in zip(cuts, cut_seen, h, strict=True)]
    model = ordinal.fit(np.concatenate(texts), np.r_[0, np.cumsum([len(t) for t in texts])], np.array(grades))
    assert np.allclose(model.weights[:13], weights, atol=2e-3) and not model.weights[13:].any()
    assert np.allclose(model.thresholds, cuts, atol=2e-3) and model.thresholds[0] < model.thresholds[1]
    assert likelihood(model.weights[:13], model.thresholds) > likelihood([0.0] * 13, model.thresholds) + 0.1


def test_latent_space_is_fitted_on_every_passage(spark, prose):
    docs = [(i, " ".join(prose(50 + 3 * i))) for i in range(80)] + [(80, None), (81, "")]
    items = decontaminate.Items.of([{"item_id": k, "text": " ".join(prose(30))} for k in range(8)])
    terms, own = len(items.terms), items.segments()[0]
    weights = np.linspace(0.5, 2, terms)

    def basis(df, step):
        counted = df.select("text").mapInArrow(decontaminate._counter(items), "term int, n long, passage binary")
        return decontaminate.latent_basis(counted.where("term = -2").select("n", "passage"), weights, own, 3.0, rank=20, fit_passages=step)

    one, many = basis(frame(spark, docs).coalesce(1), 10_000), basis(frame(spark, docs[::-1]).repartition(5), 7)
    assert np.array_equal(one, many)
    gram = np.zeros((terms, terms))
    passages = [(1.0, w[k : k + 24]) for _, t in docs if t for w in [t.split()] for k in range(0, len(w), 24)]
    numbers = [(b, decontaminate.term_numbers(decontaminate.rolling.words([" ".join(w).encode()], fold=True, plain=True).values, items.terms)) for b, w in passages]
    for times, row in [*numbers, *[(3.0, x) for x in own]]:
        v = np.bincount(row[row >= 0], minlength=terms) * weights
        gram += times * np.outer(v, v) / max(v @ v, 1e-18)
    assert terms <= decontaminate.COLUMNS and len(passages) > 400
    want = np.linalg.eigvalsh(gram)[::-1][:20]
    assert np.allclose(np.linalg.eigvalsh(one.T @ gram @ one)[::-1], want, rtol=1e-3)


def test_latent_space_of_many_terms(spark, monkeypatch):
    """Sparse directions keep nearly all that the best ones of that rank do."""
    rng = np.random.default_rng(4)
    rows = [np.sort(rng.choice(np.arange(300)[k % 12 :: 12], 12)) for k in range(500)]
    packed = [(1, bytes([12]) + r.astype("<u2").tobytes()) for r in rows]
    frame_of = lambda: spark.createDataFrame(packed, "n long, passage binary")
    full = decontaminate.latent_basis(frame_of(), np.ones(300), [], 1.0, rank=12)
    gram = sum(np.outer(v, v) / (v @ v) for v in (np.bincount(r, minlength=300) for r in rows))
    monkeypatch.setattr(decontaminate, "COLUMNS", 60)
    held = lambda b: np.trace(b.T @ gram @ b)
    assert held(decontaminate.latent_basis(frame_of(), np.ones(300), [], 1.0, rank=12)) > 0.9 * held(full)
