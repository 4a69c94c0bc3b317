"""Quality grades by ordinal regression with cumulative logits over hashed text.

A text has one score, the weights of its hashed words and word shapes; ordered thresholds cut it into
grades: P(grade >= g) = sigmoid(score - threshold g). From these come the expected grade and the
probability of the upper grades, by which documents are selected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnguard.llm.sampling import thinned
from txnguard.llm.words import Words, find_words, mix, row_slices

BITS = 18
AFFIXES = (1, -1, -2, -3)
#: The fit looks at this many labelled documents of each grade at most, none longer than MAX_CHARS.
SAMPLE, MAX_CHARS = 1000, 20_000


@dataclass
class Model:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one less than there are grades


def counts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, feature, value): for each row its features, each the share of words that have it, as a
    square root, and a few numbers on the whole text."""
    words: Words = find_words(texts, affixes=AFFIXES)
    n = len(words.counts)
    shift = np.uint64(64 - BITS)
    kinds = [words.hash, *words.affixes, (words.end - words.start).clip(0, 20).astype(np.uint64)]
    rows, features, values = [], [], []
    per = np.maximum(words.counts, 1)
    for k, x in enumerate(kinds):
        number = (mix(x + np.uint64(k * 104729 + 1)) >> shift).astype(np.int64)
        pair, times = np.unique(words.row * np.int64(1 << BITS) + number, return_counts=True)
        row = pair >> BITS
        rows.append(row)
        features.append(pair & ((1 << BITS) - 1))
        values.append(np.sqrt(times / per[row]))
    # Share of different words, and length, as features of their own.
    distinct = np.bincount(rows[0], minlength=n) / per
    for k, value in enumerate((distinct, np.log1p(words.counts) / 10)):
        rows.append(np.arange(n))
        features.append(np.full(n, 2 * k + 1))
        values.append(value)
    return np.concatenate(rows), np.concatenate(features), np.concatenate(values)


def scores(weights: np.ndarray, texts: pa.Array) -> np.ndarray:
    row, feature, value = counts(texts)
    return np.bincount(row, weights[feature] * value, len(texts))


def _upper(score: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """P(grade >= g) for g = 0, 1, ..., and 0 for the one past the last."""
    p = 1 / (1 + np.exp(-np.clip(score[:, None] - thresholds, -30, 30)))
    return np.concatenate([np.ones((len(score), 1)), p, np.zeros((len(score), 1))], axis=1)


def fit(texts: list[str], grade: np.ndarray, weight: np.ndarray, grades: int, rounds: int = 120) -> Model:
    """Greatest likelihood with a ridge. ``weight`` is how many documents each stands for."""
    row, feature, value = counts(pa.array(texts, pa.string()))
    n = len(texts)
    weights = np.zeros(1 << BITS)
    share = np.array([weight[grade >= g].sum() for g in range(1, grades)]) / max(weight.sum(), 1e-9)
    share = np.clip(share, 0.001, 0.999)
    first = np.log((1 - share) / share)
    # Thresholds are the first and positive gaps, so they stay in order.
    gaps = np.log(np.maximum(np.diff(first), 1e-3))
    base = first[0] if grades > 1 else 0.0
    w = weight / max(weight.mean(), 1e-9) if n else weight
    squares = np.full(1 << BITS, 1e-8)
    square_base, square_gaps = 1e-8, np.full(len(gaps), 1e-8)
    for _ in range(rounds if n else 0):
        thresholds = base + np.concatenate([[0], np.cumsum(np.exp(gaps))])
        score = np.bincount(row, weights[feature] * value, n)
        p = _upper(score, thresholds)
        slope = p * (1 - p)
        at = np.arange(n)
        mass = np.maximum(p[at, grade] - p[at, grade + 1], 1e-9)
        up, down = w * slope[at, grade] / mass, w * slope[at, grade + 1] / mass
        # How the log likelihood changes with the score, and with each threshold.
        by_score = up - down
        by_threshold = np.zeros(grades + 1)
        np.subtract.at(by_threshold, grade, up)
        np.add.at(by_threshold, grade + 1, down)
        by_threshold = by_threshold[1:grades]
        grad = np.bincount(feature, by_score[row] * value, 1 << BITS) - 0.02 * weights
        squares += grad**2
        weights += 0.3 * grad / np.sqrt(squares)
        total = by_threshold.sum()
        square_base += total**2
        base += 0.1 * total / np.sqrt(square_base)
        after = np.cumsum(by_threshold[::-1])[::-1][1:] * np.exp(gaps)
        square_gaps += after**2
        gaps = gaps + 0.1 * after / np.sqrt(square_gaps)
    thresholds = base + np.concatenate([[0], np.cumsum(np.exp(gaps))])
    return Model(weights.astype(np.float32), thresholds[: grades - 1])


def train(docs: DataFrame, ratings: DataFrame, grades: int, id_col: str = "doc_id", text_col: str = "text", rating_id: str = "doc_id", rating_col: str = "grade", sample: int = SAMPLE) -> Model:
    """A model from documents and ratings from 0 to ``grades`` - 1 (others, and null ids, are not used).

    Fitted on at most ``sample`` documents of each grade, of at most 20,000 characters, picked by a hash
    of the id, so reruns agree; each stands for as many as its grade has. Grades without documents
    are never expected; without ratings all grades are alike.
    """
    known = ratings.select(F.col(rating_id).alias("id"), F.col(rating_col).cast("int").alias("grade")).where(
        f"id IS NOT NULL AND grade BETWEEN 0 AND {grades - 1}"
    )
    total = dict(known.groupBy("grade").count().collect())
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    source = source.where(F.length("text") <= MAX_CHARS)
    picked = []
    for g in sorted(total):
        these = known.where(F.col("grade") == g).withColumn("h", F.xxhash64("id"))
        picked.append(thinned(these, total[g], sample).distinct().orderBy("h", "id").limit(sample))
    if not picked:
        return fit([], np.array([], np.int64), np.array([], np.float64), grades)
    # All grades in one pass over the texts. A rated id may be that of many rows: these are cut in order.
    some = source.join(F.broadcast(reduce(DataFrame.unionByName, picked)), "id")
    place = F.row_number().over(Window.partitionBy("grade").orderBy("h", "id", F.xxhash64("text"), "text"))
    rows = some.withColumn("n", place).where(F.col("n") <= 2 * sample).select("grade", "text").collect()
    rows = sorted((r["grade"], r["text"]) for r in rows)
    texts, grade = [t for _, t in rows], [g for g, _ in rows]
    weight = [total[g] / grade.count(g) for g in grade]
    return fit(texts, np.array(grade, np.int64), np.array(weight, np.float64), grades)


def _grade(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = model.value
        for batch in batches:
            for first, last in row_slices(batch.column(1), 1 << 21):
                part = batch.slice(first, last - first)
                p = _upper(scores(own.weights, part.column(1)), own.thresholds)[:, :-1]
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, p.size + 1, p.shape[1]).astype(np.int32)), pa.array(p.reshape(-1))
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(p[:, 1:].sum(axis=1)), lists], ["row", "expected", "at_least"]
                )

    return run


def grade(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """(row, expected, at_least): ``row`` holds all columns of ``docs``, expected is the expected grade,
    at_least[g] the probability of grade g or more.

    Whole texts are read, of any length. Null and empty texts get the grade of a text without words.
    Repeated rows are graded each for itself. No rows give no rows.
    """
    packed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)
    extra = T._parse_datatype_string("expected double, at_least array<double>")
    return packed.mapInArrow(_grade(shared), T.StructType([packed.schema["row"], *extra.fields]))


def select(docs: DataFrame, model: Model, least: int, probability: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` that reach grade ``least`` with the given probability; all columns are kept."""
    return grade(docs, model, text_col).where(F.col("at_least")[least] >= probability).select("row.*")
