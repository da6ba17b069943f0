"""Quality classifier by positive-unlabelled learning.

Trusted positives are documents labelled good; the unlabelled side is a sample of the web text itself, good and bad. With the share
of good documents (the class prior) estimated from the training labels, the risk over unlabelled text minus the positives' part of it is
an unbiased estimate of the risk over bad documents; where it falls below zero, which only overfitting can
do, the step goes the other way (non-negative estimator). The model is logistic over features of a text's form: nothing but the
text goes in.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Character classes of a byte; pairs of neighbouring classes are counted.
LOWER, UPPER, DIGIT, BLANK, LINE, STOP, QUOTE, MARK, WIDE = range(9)
N_CLASSES = 9
_CLASS = np.full(256, MARK, np.uint8)
_CLASS[ord("a") : ord("z") + 1] = LOWER
_CLASS[ord("A") : ord("Z") + 1] = UPPER
_CLASS[ord("0") : ord("9") + 1] = DIGIT
_CLASS[[9, 32]] = BLANK
_CLASS[[10, 11, 12, 13]] = LINE
_CLASS[[ord(c) for c in ".,;:?!"]] = STOP
_CLASS[[ord(c) for c in "'\"()-"]] = QUOTE
_CLASS[128:] = WIDE
N_FEATURES = 18 + N_CLASSES * N_CLASSES


def features(text: str) -> np.ndarray:
    """Form of a text: sizes, repetition of words and lines, marks, letter case, pairs of character classes. All 0 if empty."""
    out = np.zeros(N_FEATURES, np.float64)
    data = np.frombuffer(text.encode(), np.uint8)
    words = text.split()
    n, size = len(words), len(data)
    if not size:
        return out
    kinds = _CLASS[data]
    share = np.bincount(kinds, minlength=N_CLASSES) / size
    bytes_used = np.bincount(data, minlength=256)
    marks = bytes_used[_CLASS == MARK]
    out[0] = 1.0
    out[1] = np.log1p(size) / 10
    if n:
        distinct = set(words)
        out[2] = len(distinct) / n
        out[3] = len(distinct) / np.sqrt(n) / 10
        out[4] = sum(map(eq, words, words[1:])) / n
        out[5] = len(set(zip(words, words[1:], strict=False))) / max(1, n - 1)
        out[6] = np.minimum(size / n, 40) / 10
        out[7] = np.log1p(n) / 10
    lines = [line for line in text.split("\n") if line]
    if lines:
        out[8] = len(set(lines)) / len(lines)
        out[9] = min(200, size / len(lines)) / 100
        out[10] = np.log1p(len(lines)) / 5
    out[11] = marks.max() / size * 10
    out[12] = marks.sum() / size * 10
    out[13] = bytes_used[ord("!")] / size * 10
    out[14] = bytes_used[ord("|")] / size * 10
    out[15] = share[UPPER] / max(1e-9, share[UPPER] + share[LOWER] + share[WIDE])
    out[16] = share[DIGIT] * 10
    used = bytes_used[bytes_used > 0] / size
    out[17] = -(used * np.log2(used)).sum() / 8
    if size > 1:
        pairs = kinds[:-1].astype(np.int64) * N_CLASSES + kinds[1:]
        out[18:] = np.sqrt(np.bincount(pairs, minlength=N_CLASSES**2) / (size - 1))
    return out


class Model:
    """Logistic model over standardised features and their squares."""

    def __init__(self, centre: np.ndarray, scale: np.ndarray, weights: np.ndarray, bias: float):
        self.centre, self.scale, self.weights, self.bias = centre, scale, weights, bias

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -8, 8)
        return np.concatenate([z, z * z - 1], axis=-1)

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = np.clip(self.expand(x) @ self.weights + self.bias, -60, 60)
        return 1 / (1 + np.exp(-margin))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 300, rate: float = 0.03, decay: float = 1e-3) -> Model:
    """Minimises the non-negative unbiased risk with the logistic loss, by full-batch adaptive gradient steps."""
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(2 * N_FEATURES), 0.0)
    model = Model(unlabelled.mean(0), unlabelled.std(0) + 1e-3, np.zeros(2 * N_FEATURES), float(np.log(prior / (1 - prior))))
    p, u = model.expand(positive), model.expand(unlabelled)
    size = p.shape[1] + 1
    p, u = (np.concatenate([x, np.ones((len(x), 1))], axis=1) for x in (p, u))
    w = np.append(model.weights, model.bias)
    first, second = np.zeros(size), np.zeros(size)
    sigmoid = lambda m: 1 / (1 + np.exp(-np.clip(m, -60, 60)))
    least, best = np.inf, w
    for step in range(1, steps + 1):
        sp, su = sigmoid(p @ w), sigmoid(u @ w)
        # d loss(+) = s - 1, d loss(-) = s; loss(-) = -log(1 - s).
        as_bad = prior * p.T @ sp / len(p)
        bad_risk = -np.log1p(-np.clip(su, 0, 1 - 1e-12)).mean() + prior * np.log1p(-np.clip(sp, 0, 1 - 1e-12)).mean()
        # A step against a negative risk may leave the valley: the best point on the way is kept.
        risk = -prior * np.log(np.clip(sp, 1e-12, 1)).mean() + max(0.0, bad_risk) + decay / 2 * (w[:-1] ** 2).sum()
        if risk < least:
            least, best = risk, w
        of_bad = u.T @ su / len(u) - as_bad
        gradient = prior * p.T @ (sp - 1) / len(p) + of_bad if bad_risk >= 0 else -of_bad
        gradient = gradient + decay * np.append(w[:-1], 0)
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        w = w - rate * (1 - step / (steps + 1)) * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Model(model.centre, model.scale, best[:-1], float(best[-1]))


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the doc_id's text leaves 1 when divided by 3; a null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [features(text).tolist() for text in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=["role", "features"])


def train(docs: DataFrame, labels: DataFrame, positives: int = 6000, unlabelled: int = 10_000) -> Model:
    """Fits a model on bounded samples: `positives` good documents and `unlabelled` documents of any kind, at most.

    Labels are used of rows that are not held out only: as trusted positives, and as the share of good ones among all of them,
    which is the class prior. Samples are the rows of smallest doc_id hash. Their features reach the driver: samples x features numbers.
    Without positives every score is 0.5.
    """
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~is_held_out(F.col("doc_id")))
    prior = known.agg(F.avg("quality")).first()[0]
    order = F.xxhash64("doc_id")
    texts = docs.filter(F.col("doc_id").isNotNull())
    trusted = known.filter("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(1).alias("role")).distinct().orderBy(order).limit(positives)
    sample = (
        texts.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit(0).alias("role"))
        .filter(~is_held_out(F.col("doc_id"))).distinct().orderBy(order, "doc_id").limit(unlabelled)
    )
    chosen = trusted.unionByName(sample)
    # At most positives + unlabelled ids.
    rows = (
        texts.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id").select("role", "text").mapInArrow(_measure, "role int, features array<double>").toArrow()
    )
    values = rows["features"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)
    roles = rows["role"].to_numpy()
    # The order of rows must not depend on the tasks.
    order_of = np.lexsort(values.T[::-1])
    values, roles = values[order_of], roles[order_of]
    return fit(values[roles == 1], values[roles == 0], float(np.clip(prior if prior is not None else 0.5, 0.05, 0.95)))


def score_column(model: Model, text: Column) -> Column:
    """Score of a text, 0 to 1, higher: better; a null text is scored as the empty one. Nothing is shuffled."""

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        rows = [features(text) for text in texts.fillna("")]
        return pd.Series(model.score(np.array(rows)) if rows else [], dtype="float64")

    return score(text.cast("string"))


def classify(docs: DataFrame, labels: DataFrame, positives: int = 6000, unlabelled: int = 10_000) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted. Repeated rows each give a row; a null doc_id stays null and is not held out.

    Only the text decides a score. Other columns are ignored; an empty table gives no rows.
    """
    model = train(docs, labels, positives, unlabelled)
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), is_held_out(F.col("doc_id")).alias("held_out"),
        score_column(model, F.col("text")).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
