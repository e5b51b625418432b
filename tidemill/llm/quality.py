"""Quality scores learned from preferences between documents (Bradley-Terry), and a cut at a score quantile.

A document's strength is a weighted sum of features of its text. That a document labelled 1 is preferred to one labelled 0
has probability sigmoid(strength difference), so the weights come from logistic loss on feature differences of such pairs.
Strength alone orders documents; the cut is the strength quantile, over all labelled training documents, at the share of
label 0 among them, and the score is a sigmoid that is ``at_cut`` there.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, small_side
from .common import blocks, id_and_text, rows

#: Labelled rows of each class that the weights are fitted on, about; a hash of doc_id picks them if there are more.
SAMPLE_ROWS = 8_000
#: Pairs made of them.
PAIRS = 60_000
_COMMON = set(b".,;:'\"?-()")


def _class(test) -> np.ndarray:
    return np.array([test(b) for b in range(256)], dtype=np.float64)


#: Byte classes whose shares of a text are features.
_CLASSES = np.stack([
    _class(lambda b: 65 <= b <= 90),  # A-Z
    _class(lambda b: 97 <= b <= 122),  # a-z
    _class(lambda b: 48 <= b <= 57),  # digits
    _class(lambda b: b == 33),  # exclamation marks
    _class(lambda b: b < 128 and chr(b).isprintable() and not chr(b).isalnum() and b not in _COMMON and b not in b" !"),  # signs
    _class(lambda b: b in _COMMON),  # punctuation
    _class(lambda b: b in b" \t\n\v\f\r"),  # white space
    _class(lambda b: 0x80 <= b <= 0x9E),  # among others, capitals of Latin-1
    _class(lambda b: b >= 0xA0),
    _class(lambda b: b == 10),  # line ends
], axis=1)
N_SHARES = _CLASSES.shape[1] + 4
WIDTH = 2 * N_SHARES + 2


def features(data: bytes) -> np.ndarray:
    """Shares of byte classes, of repeated and of distinct words and the like, their roots, and two of the length."""
    counts, words, same, distinct, odd = np.zeros(256), 0, 0, 0, 0
    for block in blocks(data):
        counts += np.bincount(np.frombuffer(block, dtype=np.uint8), minlength=256)
        own = block.split()
        words += len(own)
        same += sum(map(eq, own, own[1:]))
        kinds = set(own)
        distinct += len(kinds)
        odd += sum(not (w[-1:].isalnum() or w[-1] in _COMMON or w[-1] >= 128) for w in kinds)
    n, w = max(len(data), 1), max(words, 1)
    shares = np.concatenate([counts @ _CLASSES / n, [same / w, distinct / w, odd / max(distinct, 1), min(len(data) / w / 40, 1)]])
    return np.concatenate([shares, np.sqrt(shares), [log(1 + words), float(words == 0)]])


class Model(NamedTuple):
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray

    def strength(self, data: bytes) -> float:
        return float((features(data) - self.mean) / self.spread @ self.weights)


def fit_pairs(good: np.ndarray, bad: np.ndarray, pairs: int = PAIRS, ridge: float = 1e-3, seed: int = 17) -> Model:
    """Weights from ``pairs`` random pairs of a row of ``good`` and one of ``bad``, by Newton's method; zeros if either is empty."""
    if not len(good) or not len(bad):
        return Model(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH))
    every = np.concatenate([good, bad])
    mean, spread = every.mean(axis=0), every.std(axis=0)
    spread[spread < 1e-9] = 1.0
    rng = np.random.default_rng(seed)
    pick = lambda rows_: ((rows_ - mean) / spread)[rng.integers(0, len(rows_), pairs)]
    d = pick(good) - pick(bad)
    w = np.zeros(d.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(np.clip(d @ w, -500, 500)))  # probability of the preference that was not seen
        gradient = -(d.T @ p) / pairs + ridge * w
        curvature = (d.T * (p * (1 - p))) @ d / pairs + ridge * np.eye(len(w))
        step = np.linalg.solve(curvature, gradient)
        step *= min(1.0, 5.0 / max(np.linalg.norm(step), 1e-12))
        w -= step
        if np.linalg.norm(step) < 1e-6:
            break
    return Model(mean, spread, w)


def fold_of(doc_id: Column) -> Column:
    """crc32 of the decimal doc_id, modulo 4."""
    return F.crc32(doc_id.cast("long").cast("string")) % 4


def training_labels(labels: DataFrame, column: str, held_out_fold: int) -> DataFrame:
    """Distinct (doc_id, label) of the rows that may be learned from."""
    named = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(column).cast("int").alias("label"))
    return named.where(F.col("label").isin(0, 1) & (fold_of(F.col("doc_id")) != held_out_fold)).distinct()


def fit(docs: DataFrame, train: DataFrame, sample_rows: int = SAMPLE_ROWS, pairs: int = PAIRS) -> Model:
    """Model from about ``sample_rows`` documents of each class of ``train`` (doc_id, label); only they come to the driver.

    A document of several rows counts once, with the mean of their features.
    """
    sizes = {r.label: r.n for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return fit_pairs(np.zeros((0, WIDTH)), np.zeros((0, WIDTH)))
    share = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1_000_000))
    limit = F.when(F.col("label") == 1, min(1.0, sample_rows / sizes[1]) * 1e6).otherwise(min(1.0, sample_rows / sizes[0]) * 1e6)
    picked = train.where(share < limit).select(F.col("doc_id").alias("_id"), "label").limit(4 * sample_rows)
    found = id_and_text(docs).join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).drop("_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = pa.array([features(data or b"") for _, data in rows(batch)], pa.list_(pa.float64()))
            yield pa.record_batch([batch.column("doc_id"), batch.column("label"), out], names=["doc_id", "label", "f"])

    means = F.array(*[F.avg(F.col("f")[i]) for i in range(WIDTH)])
    table = found.mapInArrow(run, "doc_id long, label int, f array<double>").groupBy("doc_id", "label").agg(means.alias("f")).collect()
    table.sort(key=lambda r: (r.label, r.doc_id))
    of = {k: np.array([r.f for r in table if r.label == k]).reshape(-1, WIDTH) for k in (0, 1)}
    return fit_pairs(of[1], of[0], pairs)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    column: str = "quality",
    held_out_fold: int = 2,
    at_cut: float = 0.7,
    sample_rows: int = SAMPLE_ROWS,
    pairs: int = PAIRS,
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, score, predicted.

    Label rows in fold ``held_out_fold`` are not learned from, nor do they move the cut. ``score`` is between 0 and 1 and
    ``predicted`` is 1 where it is ``at_cut`` or more. Only the text goes into a score. Weights are fitted on a sample of about
    ``sample_rows`` rows of either class; the cut is taken over all training rows.

    A null text counts as empty, which has a score too. A row without doc_id is scored and not held out. Rows that repeat a
    doc_id are scored each. Label rows that are null, neither 0 nor 1, or repeated do not count; a document labelled both ways
    counts on both sides. Without training rows of both classes every score is ``at_cut``. An empty table gives no rows.
    """
    train = cut_lineage(training_labels(labels, column, held_out_fold))
    model = fit(docs, train, sample_rows, pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [model.strength(data or b"") for _, data in rows(batch)]
            yield pa.record_batch([batch.column("doc_id"), pa.array(out, pa.float64())], names=["doc_id", "strength"])

    strengths = cut_lineage(id_and_text(docs).mapInArrow(run, "doc_id long, strength double"))
    known = strengths.join(train, "doc_id").agg(
        F.mean(1 - F.col("label")).alias("bad"), F.stddev_pop("strength").alias("spread"), F.count(F.lit(1)).alias("n")
    )
    found = known.first()
    cut, scale = 0.0, 1.0
    if found.n and 0 < found.bad < 1 and found.spread:
        levels = [max(found.bad - 0.002, 0.0), min(found.bad + 0.002, 1.0)]
        around = strengths.join(train, "doc_id").agg(F.percentile_approx("strength", levels, 20_000).alias("q")).first().q
        cut, scale = sum(around) / 2, found.spread / 4
    score = 1 / (1 + F.exp(-((F.col("strength") - cut) / scale + log(at_cut / (1 - at_cut)))))
    scored = strengths.select(
        "doc_id", F.coalesce(fold_of(F.col("doc_id")) == held_out_fold, F.lit(False)).alias("held_out"), score.alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= at_cut).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents whose rows are all predicted 0; all columns stay, and so do rows without doc_id."""
    found = quality_scores(docs, labels)
    worst = found.groupBy("doc_id").agg(F.max("predicted").alias("best")).where("best = 0")
    drop = small_side(cut_lineage(worst.select(F.col("doc_id").alias("_drop"))))
    return docs.join(drop, F.col("doc_id") == F.col("_drop"), "left_anti")
