"""Repeats against a plain check of every window."""

import random

import pytest

from grainmill.llm import substring

SCHEMA = "doc_id long, text string, lang string"


def brute(rows):
    """(doc_id, kept text, removed) of every row, in the order of doc_id and text."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or ""))
    seen, out = set(), []
    for doc_id, text, *_ in rows:
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - substring.WINDOW + 1):
            window = tuple(words[i : i + substring.WINDOW])
            if window in seen:
                gone[i : i + substring.WINDOW] = [True] * substring.WINDOW
            seen.add(window)
        out.append((doc_id, b" ".join(w for w, g in zip(words, gone) if not g).decode(), sum(gone)))
    return sorted(out, key=str)


def result(spark, rows, **sizes):
    frame = substring.without_repeats(spark.createDataFrame(rows, SCHEMA), **sizes)
    return sorted(((r.doc_id, r.text, r.n_removed) for r in frame.collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, seed):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}é" for i in range(30)]
    passages = [[rnd.choice(vocabulary) for _ in range(rnd.choice([19, 20, 21, 35, 60]))] for _ in range(6)]
    rows = []
    for doc_id in range(40):
        words = []
        for _ in range(rnd.randrange(6)):
            words += rnd.choice(passages) if rnd.random() < 0.5 else [rnd.choice(vocabulary) for _ in range(rnd.randrange(40))]
        rows.append((doc_id * 7, rnd.choice([" ", "\n", " \t"]).join(words), "x"))
    assert result(spark, rows, chunk_bytes=1500, bucket_bytes=2000) == brute(rows)


def test_odd_rows(spark):
    long = " ".join(f"v{i % 997}" for i in range(30_000))
    same = " ".join(f"p{i}" for i in range(25))
    rows = [
        (1, None, "a"), (2, "", "a"), (3, same, None), (3, same, "b"), (None, same + " tail", "c"), (4, long, "d"),
        (5, "a " * 50, "e"), (6, "x y " + same, "f"), (7, same[:-1], "g"),
    ]
    assert result(spark, rows) == brute(rows)
    assert result(spark, rows, chunk_bytes=100) == brute(rows)


def test_empty(spark):
    assert result(spark, []) == []
