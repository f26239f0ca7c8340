"""Quality grade of a text by ordinal cumulative-link regression on hashed words.

Ratings form three grades: 0 toxic, 1 poor, 2 good. One weight vector is shared by all grades; ordered thresholds cut the score:
P(grade <= k) = logistic(threshold k - score). The score adds the weights of the distinct words of the whole text, of their first
letters, and of a few shares (symbols, exclamation marks, capitals, distinct words, length) in bins.

The model is fitted on at most ``max_labelled`` rated documents, those whose doc_id comes first in a keyed order; ratings are
bounded by that parameter, so they go to one task, and the model of 2 ** HASH_BITS weights at most goes to all tasks. Scoring is
one pass without a shuffle over all documents.

Defined results: null text is the empty text; a null toxic rating is not toxic, a rating without quality counts only when toxic; of
several ratings of a document the lowest counts; without any rating the scores are null and every row is kept; repeated rows are
scored alike; an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import rolling

GRADES = 3
HASH_BITS = 18
MAX_LABELLED = 10_000
PREFIX_BYTES = 5
KEEP_ABOVE = 0.6
STEPS = 300
RATE = 0.1
L1 = 1e-3

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray

    def probabilities(self, scores: np.ndarray) -> np.ndarray:
        """P(grade <= k) of every score, one column per threshold."""
        return 1 / (1 + np.exp(np.clip(scores[:, None] - self.thresholds[None, :], -30, 30)))


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the distinct features of each text, and where each text's begin (one more than texts)."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    stops = np.cumsum([len(t) + 1 for t in texts])
    brk = rolling._NOT_PLAIN[data]
    before = np.r_[True, brk[:-1]]
    starts, ends = np.flatnonzero(~brk & before), np.flatnonzero(brk & ~before)
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(rolling._FOLDED[data] * rolling.powers(rolling.BYTE_BASE, len(data)), out=run[1:])
    back = rolling.powers(rolling.inverse(rolling.BYTE_BASE), len(data))[starts]
    short = np.minimum(ends, starts + PREFIX_BYTES)
    doc = np.searchsorted(stops, starts, side="right")
    mask = np.uint64((1 << HASH_BITS) - 1)

    def numbered(until: np.ndarray, salt: int) -> np.ndarray:
        return (rolling.mix((run[until] - run[starts]) * back + np.uint64(salt)) & mask).astype(np.int64)

    def distinct(number: np.ndarray) -> np.ndarray:
        keys = np.sort((doc << HASH_BITS) | number)
        return keys[np.r_[True, keys[1:] != keys[:-1]]] if len(keys) else keys

    own, n = distinct(numbered(ends, 1)), len(texts)
    begins = np.r_[0, stops[:-1]]
    per = lambda flags: np.add.reduceat(flags.astype(np.int64), begins)
    words = np.maximum(np.bincount(doc, minlength=n), 1)
    space = rolling._SPACE[data]
    spaced = np.maximum(per(~space & np.r_[True, space[:-1]]), 1)
    letters = np.maximum(per(~brk), 1)
    shares = [
        per(_SYMBOL[data]) / spaced, per(data == 0x21) / spaced, per((data >= 0x41) & (data <= 0x5A)) / letters,
        np.bincount(own >> HASH_BITS, minlength=n) / words, np.log2(spaced) / 16,
    ]
    rows = np.arange(n)
    bins = [
        (rows << HASH_BITS) | (rolling.mix(np.uint64(1000 * (k + 1)) + np.minimum(10 * s, 10).astype(np.uint64)) & mask).astype(np.int64)
        for k, s in enumerate(shares)
    ]
    keys = np.sort(np.concatenate([own, distinct(numbered(short, 2)), *bins]))
    return keys & ((1 << HASH_BITS) - 1), np.searchsorted(keys >> HASH_BITS, np.arange(n + 1))


def fit(numbers: np.ndarray, offsets: np.ndarray, grades: np.ndarray) -> Model:
    """Adaptive gradient steps with soft thresholding; features of fewer than three texts are left out."""
    size = 1 << HASH_BITS
    seen = np.bincount(numbers, minlength=size)
    rows = np.repeat(np.arange(len(grades)), np.diff(offsets))
    often = seen[numbers] > 2
    numbers, rows = numbers[often], rows[often]
    weights, gathered = np.zeros(size), np.full(size, 1e-8)
    share = np.cumsum(np.bincount(grades, minlength=GRADES) + 1.0)[:-1] / (len(grades) + GRADES)
    cuts, cut_gathered = np.log(share / (1 - share)), np.full(GRADES - 1, 1e-8)
    logistic = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))
    for _ in range(STEPS):
        score = np.bincount(rows, weights[numbers], len(grades))
        edges = np.concatenate([[-np.inf], cuts, [np.inf]])
        upper, lower = logistic(edges[grades + 1] - score), logistic(edges[grades] - score)
        upper[grades == GRADES - 1], lower[grades == 0] = 1, 0
        slope = (1 - upper - lower) / len(grades)
        gradient = np.bincount(numbers, slope[rows], size)
        gathered += gradient**2
        step = RATE / np.sqrt(gathered)
        moved = weights - step * gradient
        weights = np.sign(moved) * np.maximum(np.abs(moved) - step * L1, 0)
        chance = np.maximum(upper - lower, 1e-9)
        cut_gradient = np.array([
            (np.where(grades == k + 1, lower * (1 - lower), 0) - np.where(grades == k, upper * (1 - upper), 0)) @ (1 / chance) / len(grades)
            for k in range(GRADES - 1)
        ])
        cut_gathered += cut_gradient**2
        cuts = np.maximum.accumulate(cuts - 0.1 * cut_gradient / np.sqrt(cut_gathered))
    return Model(weights.astype(np.float32), cuts)


def _graded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
        for begin, end in rolling.pieces(texts):
            numbers, offsets = features(texts[begin:end])
            packed = [numbers[a:b].astype(np.int32).tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            rows = batch.slice(begin, end - begin)
            yield pa.RecordBatch.from_arrays([rows.column("pick"), rows.column("grade"), pa.array(packed, pa.binary())], ["pick", "grade", "numbers"])


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grades, parts = [], []
    for batch in batches:
        grades += batch.column("grade").to_pylist()
        parts += [np.frombuffer(x, np.int32) for x in batch.column("numbers").to_pylist()]
    if grades:
        model = fit(np.concatenate(parts), np.r_[0, np.cumsum([len(p) for p in parts])], np.array(grades))
        yield pa.RecordBatch.from_pydict({"weights": [model.weights.tobytes()], "thresholds": [model.thresholds.tobytes()]})


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model | None:
    """A model from the ratings of at most ``max_labelled`` documents; None where there are none."""
    grade = F.when(F.coalesce("toxic", F.lit(0)) == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    pick = F.md5(F.concat_ws("/", F.lit("rating"), F.col("doc_id").cast("string")))
    rated = labels.select("doc_id", grade.alias("grade")).where("doc_id is not null and grade is not null")
    rated = rated.groupBy("doc_id").agg(F.min("grade").alias("grade")).withColumn("pick", pick)
    rated = rated.orderBy("pick").limit(max_labelled)
    # At most max_labelled rows of three short columns, whatever the input.
    joined = docs.select("doc_id", "text").join(F.broadcast(rated.withColumnRenamed("doc_id", "r_id")), F.col("doc_id") == F.col("r_id"))
    rows = joined.select("pick", "grade", "text").mapInArrow(_graded, "pick string, grade int, numbers binary")
    fitted = rows.orderBy("pick").limit(max_labelled).mapInArrow(_fitted, "weights binary, thresholds binary").first()
    return fitted and Model(np.frombuffer(bytes(fitted["weights"]), np.float32), np.frombuffer(bytes(fitted["thresholds"])))


def _scorer(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            scores = []
            for begin, end in rolling.pieces(texts):
                numbers, offsets = features(texts[begin:end])
                run = np.r_[0.0, np.cumsum(model.weights[numbers].astype(float))]
                scores.append(run[offsets[1:]] - run[offsets[:-1]])
            below = model.probabilities(np.concatenate(scores) if scores else np.zeros(0))
            table = {n: batch.column(n) for n in batch.schema.names}
            table["expected_grade"] = pa.array((1 - below).sum(axis=1))
            table["tail_probability"] = pa.array(1 - below[:, -1])
            yield pa.RecordBatch.from_pydict(table)

    return score


def graded(docs: DataFrame, model: Model | None, keep_above: float = KEEP_ABOVE) -> DataFrame:
    """doc_id, text, expected_grade, tail_probability (of the best grade) and kept of every document."""
    rows = docs.select("doc_id", "text")
    if model is None:
        none = F.lit(None).cast("double")
        return rows.select("*", none.alias("expected_grade"), none.alias("tail_probability"), F.lit(True).alias("kept"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.mapInArrow(_scorer(model), f"doc_id {kind}, text string, expected_grade double, tail_probability double")
    return scored.withColumn("kept", F.col("tail_probability") >= keep_above)
