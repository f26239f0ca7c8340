"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from grainmill.llm import spelling

SCHEMA = "doc_id long, text string, word string, n int"


def one_edit(u: str, v: str) -> bool:
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(x != y for x, y in zip(u, v, strict=True)) == 1
    return len(v) == len(u) + 1 and any(v[:i] + v[i + 1 :] == u for i in range(len(v)))


def forms_of(counts: dict[str, int]) -> list[tuple]:
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    best = {w: min(vs, key=lambda v: (-counts[v], v)) for w, vs in near.items() if vs}
    form = {w: v for w, v in best.items() if counts[v] >= 2 * counts[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n, len(near[w]), counts[form[w]] if w in form else None) for w, n in counts.items())


def plain(docs, min_length=5, min_count=3):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return forms_of({w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count})


def rows(frame):
    names = ("word", "form", "root", "n", "n_near", "form_n")
    return sorted((tuple(r[c] for c in names) for r in frame.collect()), key=lambda r: r[0])


@pytest.mark.parametrize("seed", range(6))
def test_scan_finds_all_pairs_of_a_list(seed):
    rng = random.Random(seed)
    alphabet = "ab" if seed % 2 else "abcdé"
    texts = sorted({"".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 7))) for _ in range(120)})
    cut = rng.randrange(1, len(texts))
    groups = [sorted(texts[:cut]), sorted(texts[cut:])]
    first = np.zeros(len(texts), bool)
    first[[0, cut]] = True
    i, j = spelling.scan(groups[0] + groups[1], first)
    want = {(u, v) for g in groups for k, u in enumerate(g) for v in g[k + 1 :] if one_edit(u, v)}
    got = [(texts[x], texts[y]) for x, y in zip(i, j, strict=True)]
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("limit", [2, 5, 4096])
def test_each_pair_once_whatever_the_limit(spark, limit):
    rng = random.Random(limit)
    words = {"".join(rng.choice("abc") for _ in range(rng.randrange(1, 9))) for _ in range(150)} | {"a" * 40, "a" * 41, "a" * 39 + "b"}
    table = spark.createDataFrame([(w, rng.randrange(1, 50)) for w in sorted(words)], "word string, n long")
    got = [tuple(sorted((r.word, r.near))) for r in spelling.near_words(table, limit).collect()]
    want = {tuple(sorted((u, v))) for u in words for v in words if u < v and one_edit(u, v)}
    assert len(got) == len(set(got)) and set(got) == want
    sizes = spelling.lists(table, limit).where("b - a > 1").groupBy(*spelling.LIST).count()
    assert sizes.where(f"count > {limit}").isEmpty()


def test_documents(spark):
    rng = random.Random(5)
    base = ["colour", "Grüße", "naïveté", "internationalisation", "Études", "words", "wordsmith"]

    def typo(w):
        i = rng.randrange(len(w))
        return rng.choice([w[:i] + w[i + 1 :], w[:i] + "x" + w[i:], w[:i] + "q" + w[i + 1 :], w, w, w])

    docs = [(i, " ".join(typo(rng.choice(base)) for _ in range(30))) for i in range(150)]
    docs += [(None, "colour " * 40), (7, None), (8, ""), (9, "привет mixedпcolours 12colour3 ×÷×÷×"), (3, docs[3][1]), (3, docs[3][1])]
    docs.append((10, "z" * 5000 + " " + "z" * 5000 + " " + "z" * 5000 + " " + ("z" * 4999 + " ") * 9))
    table = spark.createDataFrame([(i, t, "clash", 1) for i, t in docs], SCHEMA)
    assert rows(spelling.spelling_variants(table)) == plain(docs)


def test_chain_of_forms_and_ties(spark):
    counts = {"chains": 100, "chain": 40, "chai": 20, "cha": 9, "chaix": 20, "other": 3}
    table = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = rows(spelling.spelling_forms(table))
    assert got == forms_of(counts)
    assert {w: r for w, _, r, *_ in got}["cha"] == "chains"


def test_empty_table(spark):
    assert rows(spelling.spelling_variants(spark.createDataFrame([], SCHEMA))) == []


def test_lists_of_one_word(spark):
    assert rows(spelling.spelling_forms(spark.createDataFrame([("lonely", 5)], "word string, n long"))) == [("lonely", None, "lonely", 5, 0, None)]
