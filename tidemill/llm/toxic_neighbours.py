"""Toxicity by votes of the nearest labelled examples: exact TF-IDF cosine over an inverted index with block maxima.

Terms are words (runs of letters, lower-cased) and the first 4, 5 and 6 letters of longer ones, as far as they go with label 1 in the
training rows: a term counts if its odds of label 1 are LIFT times those of all rows or more, and so high that, over all terms that were
looked at, chance alone would bring about less than one such term. All other words of a document count as one further term, so that a single chance hit in a long text lies apart
from a text full of them. Inverse document frequencies are taken over all documents. Near copies among the examples count once.

The index holds the examples in blocks and, for each term, the largest weight in each block. A query adds these up to a bound for
each block, works blocks out in falling order of bound and stops when no bound reaches the k-th best cosine: the neighbours are
exactly the nearest. Their votes, weighted by squared cosine and by how many training rows an example stands for, give the share of
label 1 around a document; a logistic curve fitted on votes that leave the example itself out makes it a calibrated score. The
neighbours are returned as evidence. A document without any term gets the share of label 1 among the examples without any.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from math import exp, log
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import blocks, id_and_text, rows
from .quality import fold_of, training_labels
from .shingles import Shingler

#: Labelled rows of each class that become examples, about; a hash of doc_id picks them if there are more.
SAMPLE_ROWS = 8_000
#: Examples that the calibration curve is fitted on, at most.
CALIBRATION_ROWS = 2_000
STEMS = (4, 5, 6)
NEIGHBOURS = 25
EVIDENCE = 3
BLOCK = 128
#: How many times likelier label 1 must be, in odds, for a term's documents than for all.
LIFT = 5.0
#: Documents with a term that a task scores.
TASK_ROWS = 2_000
#: Weight of the share of label 1 over all training rows in a vote, in examples at cosine 1.
PRIOR = 0.05
_WORD = re.compile(r"[^\W\d_]+")
EVIDENCE_DDL = "array<struct<doc_id:long,label:int,cosine:double>>"
EVIDENCE_TYPE = pa.list_(pa.struct([("doc_id", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())]))


def word_counts(data: bytes) -> Counter:
    """Words of a whole text, each block of it counted alone."""
    out: Counter = Counter()
    for block in blocks(data):
        out.update(_WORD.findall(block.decode("utf-8", "replace").lower()))
    return out


def terms_of(word: str) -> list[str]:
    """The word, and its first letters with a star."""
    return [word, *[word[:k] + "*" for k in STEMS if len(word) > k]]


class Vocabulary:
    """Numbers of the chosen terms; words that cannot hold one are told by their first letters."""

    def __init__(self, terms: list[str]):
        self.number = {t: i for i, t in enumerate(terms)}
        self.heads = {t.rstrip("*")[: STEMS[0]] for t in terms}

    def __call__(self, counts: Counter) -> dict[int, int]:
        """Term number to its occurrences, with all other words as one term after the last; nothing for a text without a term."""
        out: dict[int, int] = {}
        inside = 0
        for word, n in counts.items():
            if word[: STEMS[0]] in self.heads:
                found = [self.number[t] for t in terms_of(word) if t in self.number]
                for i in found:
                    out[i] = out.get(i, 0) + n
                inside += n if found else 0
        rest = sum(counts.values()) - inside
        if out and rest:
            out[len(self.number)] = rest
        return out


def vector(counts: dict[int, int], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(term numbers, weights) of length 1, by term number."""
    ids = np.array(sorted(counts), dtype=np.int64)
    weights = np.array([1 + log(counts[i]) for i in ids.tolist()]) * idf[ids] if len(ids) else np.zeros(0)
    return ids, weights / np.sqrt(weights @ weights) if len(ids) else weights


class Index:
    """Postings of each term by example, and the largest weight of each block that the term occurs in."""

    def __init__(self, doc_ids: list[int], vectors: list[tuple[np.ndarray, np.ndarray]], block: int = BLOCK):
        self.doc_ids, self.size, self.block = np.array(doc_ids, dtype=np.int64), len(doc_ids), block
        self.n_blocks, self.opened = -(-self.size // block), 0  # blocks there are, and worked out so far
        lists: dict[int, list[tuple[int, float]]] = {}
        for example, (ids, weights) in enumerate(vectors):
            for i, w in zip(ids.tolist(), weights.tolist()):
                lists.setdefault(i, []).append((example, w))
        self.postings = {}
        for i, some in lists.items():
            examples, weights = np.array([e for e, _ in some]), np.array([w for _, w in some])
            at, first = np.unique(examples // block, return_index=True)
            self.postings[i] = (examples, weights, at, np.append(first, len(examples)), np.maximum.reduceat(weights, first))

    def nearest(self, query: tuple[np.ndarray, np.ndarray], k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the k nearest with a positive cosine, nearest first, ties to the smaller doc_id.

        Sums run over the terms in the same order for bounds and cosines, so rounding never puts a bound below its cosines.
        """
        parts = [(w, self.postings[i]) for i, w in zip(*(x.tolist() for x in query)) if i in self.postings]
        bound = np.zeros(self.n_blocks)
        for w, (_, _, at, _, most) in parts:
            bound[at] += w * most
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        best, cosines = np.zeros(0, dtype=np.int64), np.zeros(0)
        begin, step = 0, max(4, k // self.block + 1)
        while begin < len(order) and (len(best) < k or bound[order[begin]] >= cosines[-1]):
            chosen = np.zeros(self.n_blocks, dtype=bool)
            chosen[order[begin : begin + step]] = True
            self.opened += len(order[begin : begin + step])
            begin, step = begin + step, step * 4
            total = np.zeros(self.size)
            for w, (examples, weights, at, first, _) in parts:
                wanted = np.repeat(chosen[at], np.diff(first))
                total[examples[wanted]] += w * weights[wanted]
            if without >= 0:
                total[without] = 0
            hit = np.flatnonzero(total)
            best, cosines = np.concatenate([best, hit]), np.concatenate([cosines, total[hit]])
            keep = np.lexsort((best, self.doc_ids[best], -cosines))[:k]
            best, cosines = best[keep], cosines[keep]
        return best, cosines


class Model(NamedTuple):
    terms: list[str]
    idf: np.ndarray
    doc_ids: list[int]  # examples with a term, in this order
    labels: np.ndarray
    vectors: list[tuple[np.ndarray, np.ndarray]]
    stands_for: np.ndarray  # by label: training rows for an example, in units of their mean
    share: float  # of label 1, over all training rows
    empty: float  # the same among those without a term
    slope: float = 1.0
    shift: float = 0.0


def votes(model: Model, best: np.ndarray, cosines: np.ndarray) -> float:
    """Share of label 1 among the neighbours, with a little of the overall share."""
    label = model.labels[best]
    weight = cosines**2 * model.stands_for[label]
    return float((PRIOR * model.share + weight @ label) / (PRIOR + weight.sum()))


def logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return log(p / (1 - p))


def fit_curve(shares: np.ndarray, labels: np.ndarray, weights: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """(slope, shift) of the logistic curve from shares to labels, drawn towards (1, 0)."""
    if not len(shares):
        return 1.0, 0.0
    x = np.stack([np.array([logit(p) for p in shares]), np.ones(len(shares))], axis=1)
    rest, w = np.array([1.0, 0.0]), weights / weights.sum()
    at = rest.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -50, 50)))
        gradient = x.T @ (w * (p - labels)) + ridge * (at - rest)
        step = np.linalg.solve((x.T * (w * p * (1 - p))) @ x + ridge * np.eye(2), gradient)
        at = at - step * min(1.0, 1.0 / max(float(np.linalg.norm(step)), 1e-12))
        if np.linalg.norm(step) < 1e-9:
            break
    return max(float(at[0]), 0.0), float(at[1])


def examples(docs: DataFrame, train: DataFrame, sample_rows: int) -> DataFrame:
    """(doc_id, label, words, counts) of about ``sample_rows`` training documents of each class; of texts with the same smallest
    five-word shingle, as most near copies have, one row."""
    sizes = {r.label: r.n for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("examples")), F.lit(1_000_000))
    limit = F.when(F.col("label") == 1, min(1.0, sample_rows / sizes.get(1, 1)) * 1e6).otherwise(min(1.0, sample_rows / sizes.get(0, 1)) * 1e6)
    picked = train.where(share < limit).select(F.col("doc_id").alias("_id"), "label").limit(4 * sample_rows)
    found = id_and_text(docs).join(F.broadcast(picked), F.col("doc_id") == F.col("_id")).drop("_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(5)
        for batch in batches:
            keys, words, counts = [], [], []
            for _, data in rows(batch):
                own, found_words = shingles(data or b""), word_counts(data or b"")
                keys.append(int(own.min()) - 2**63 if len(own) else 0)
                words.append(list(found_words))
                counts.append(list(found_words.values()))
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("label"), pa.array(keys, pa.int64()), pa.array(words, pa.list_(pa.string())),
                 pa.array(counts, pa.list_(pa.int32()))], names=["doc_id", "label", "key", "words", "counts"])

    table = cut_lineage(found.mapInArrow(run, "doc_id long, label int, key long, words array<string>, counts array<int>"))
    first = table.groupBy("label", "key").agg(F.min("doc_id").alias("doc_id"))
    one = table.join(F.broadcast(first), ["label", "key", "doc_id"], "left_semi")  # as many rows as examples at most
    return cut_lineage(one.dropDuplicates(["label", "key"]).drop("key"))


def choose_terms(some: DataFrame) -> list[str]:
    """Terms that go with label 1: so many documents of label 1 come about by chance in less than one of all terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_label = (Counter(), Counter())
        for batch in batches:
            for label, words in zip(batch.column("label").to_pylist(), batch.column("words")):
                by_label[label].update({t for w in words.as_py() for t in terms_of(w)})
        names = list(by_label[0] | by_label[1])
        for at in range(0, len(names), 50_000):
            part = names[at : at + 50_000]
            columns = [pa.array(part), *[pa.array([c[t] for t in part], pa.int64()) for c in by_label]]
            yield pa.record_batch(columns, names=["term", "other", "hits"])

    counted = some.select("label", "words").mapInArrow(run, "term string, other long, hits long")
    counted = cut_lineage(counted.groupBy("term").agg(F.sum("hits").alias("hits"), F.sum("other").alias("other")))
    sizes = {r.label: r.n for r in some.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    terms = counted.count()
    if len(sizes) < 2 or not terms:
        return []
    base, n = sizes[1] / (sizes[0] + sizes[1]), F.col("hits") + F.col("other")
    share = F.col("hits") / n
    other = F.when(F.col("other") > 0, F.col("other") * F.log((1 - share) / (1 - base))).otherwise(0.0)
    surprise = F.col("hits") * F.log(share / base) + other
    telling = F.col("hits") * sizes[0] >= LIFT * F.col("other") * sizes[1]
    kept = counted.where((F.col("hits") >= 3) & (share > base) & telling).where(surprise >= log(max(terms, 2)))
    return sorted(r.term for r in kept.select("term").collect())  # each is in several examples, so they are fewer than their words


def term_table(docs: DataFrame, terms: list[str]) -> DataFrame:
    """(doc_id, terms, counts) of each row of ``docs``, written; the one pass over all texts."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(shared.value)
        for batch in batches:
            found = [sorted(vocabulary(word_counts(data or b"")).items()) for _, data in rows(batch)]
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array([[i for i, _ in f] for f in found], pa.list_(pa.int32())),
                 pa.array([[n for _, n in f] for f in found], pa.list_(pa.int32()))], names=["doc_id", "terms", "counts"])

    return cut_lineage(id_and_text(docs).mapInArrow(run, "doc_id long, terms array<int>, counts array<int>"))


def fit(docs: DataFrame, train: DataFrame, sample_rows: int = SAMPLE_ROWS, k: int = NEIGHBOURS) -> tuple[Model, DataFrame]:
    """The model, and the table of all documents' terms. Only examples, terms and their frequencies come to the driver."""
    some = examples(docs, train, sample_rows)
    terms = choose_terms(some)
    table = term_table(docs, terms)
    total = table.count()
    frequency = table.select(F.explode("terms").alias("i")).groupBy("i").agg(F.count(F.lit(1)).alias("n")).collect()
    df = np.zeros(len(terms) + 1)
    for r in frequency:
        df[r.i] = r.n
    df[-1] = total
    idf = np.log((1 + total) / (1 + df)) + 1
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Vocabulary(shared.value)
        for batch in batches:
            found = []
            for words, counts in zip(batch.column("words"), batch.column("counts")):
                found.append(sorted(own(Counter(dict(zip(words.as_py(), counts.as_py())))).items()))
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("label"), pa.array([[i for i, _ in f] for f in found], pa.list_(pa.int32())),
                 pa.array([[n for _, n in f] for f in found], pa.list_(pa.int32()))], names=["doc_id", "label", "terms", "counts"])

    kept = some.mapInArrow(run, "doc_id long, label int, terms array<int>, counts array<int>").collect()
    kept.sort(key=lambda r: (r.terms, r.doc_id, r.label))  # like ones share blocks, which makes bounds tight
    sizes = {r.label: r.n for r in train.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    own = Counter(r.label for r in kept)
    every = sum(sizes.values())
    stands = np.array([sizes.get(x, 0) / every / (own[x] / len(kept)) if own[x] else 0.0 for x in (0, 1)])
    share = sizes.get(1, 0) / every if every else 0.0
    bare = [r.label for r in kept if not r.terms]
    weight = [stands[x] for x in bare]
    empty = (share + sum(w * x for w, x in zip(weight, bare))) / (1 + sum(weight))
    held = [r for r in kept if r.terms]
    vectors = [vector(dict(zip(r.terms, r.counts)), idf) for r in held]
    model = Model(terms, idf, [r.doc_id for r in held], np.array([r.label for r in held], dtype=np.int64), vectors, stands, share, empty)
    return calibrated(model, k), table


def calibrated(model: Model, k: int) -> Model:
    """``model`` with its curve, from at most CALIBRATION_ROWS examples, each left out of its own vote."""
    index = Index(model.doc_ids, model.vectors)
    every = np.arange(index.size)
    some = every if index.size <= CALIBRATION_ROWS else np.random.default_rng(11).choice(every, CALIBRATION_ROWS, replace=False)
    shares = np.array([votes(model, *index.nearest(model.vectors[i], k, without=i)) for i in some.tolist()])
    slope, shift = fit_curve(shares, model.labels[some], model.stands_for[model.labels[some]])
    return model._replace(slope=slope, shift=shift)


class Scorer:
    """Scores and evidence of a worker's documents."""

    def __init__(self, model: Model, k: int):
        self.model, self.k, self.index = model, k, Index(model.doc_ids, model.vectors)

    def __call__(self, counts: dict[int, int]) -> tuple[float, list[tuple[int, int, float]]]:
        m = self.model
        best, cosines = self.index.nearest(vector(counts, m.idf), self.k)
        score = 1 / (1 + exp(-(m.slope * logit(votes(m, best, cosines)) + m.shift)))
        top = zip(best[:EVIDENCE].tolist(), cosines[:EVIDENCE].tolist())
        return score, [(m.doc_ids[i], int(m.labels[i]), min(c, 1.0)) for i, c in top]


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    column: str = "toxic",
    held_out_fold: int = 2,
    cut: float = 0.3,
    sample_rows: int = SAMPLE_ROWS,
    k: int = NEIGHBOURS,
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, score, predicted, n_terms, evidence.

    ``score`` (0 to 1) is the calibrated share of label 1 among the ``k`` nearest examples, ``predicted`` is 1 where it is ``cut`` or more,
    ``n_terms`` counts the document's distinct terms, and ``evidence`` holds its nearest examples: doc_id, label, cosine. Label rows in fold
    ``held_out_fold`` are not learned from. Only texts go into scores. Examples are a sample of about ``sample_rows`` rows of each class.

    A null or empty text, like any without a term, has the score of examples without a term and no evidence. A row without doc_id is
    scored and not held out. Rows that repeat a doc_id are scored each. Label rows that are null, neither 0 nor 1, or repeated do not
    count; a document labelled both ways is an example of both. Equally near examples come by doc_id. Without training rows of
    both classes there are no terms, and every score is the share of label 1 (0 without any). Other columns are ignored. An empty
    table gives no rows.
    """
    train = cut_lineage(training_labels(labels, column, held_out_fold))
    model, table = fit(docs, train, sample_rows, k)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    some, bare = table.where(F.size("terms") > 0), table.where(F.size("terms") == 0)
    parts = max(1, min(-(-some.count() // TASK_ROWS), 1 << 16))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value, k)
        names, n_known = ["doc_id", "score", "n_terms", "evidence"], len(shared.value.terms)
        for batch in batches:
            found = [scorer(dict(zip(i.as_py(), n.as_py()))) for i, n in zip(batch.column("terms"), batch.column("counts"))]
            evidence = [[dict(zip(("doc_id", "label", "cosine"), e)) for e in some] for _, some in found]
            n_terms = pa.array([sum(i < n_known for i in x.as_py()) for x in batch.column("terms")], pa.int64())
            yield pa.record_batch([batch.column("doc_id"), pa.array([s for s, _ in found], pa.float64()), n_terms, pa.array(evidence, EVIDENCE_TYPE)], names=names)

    near = some.repartition(parts, "doc_id", "terms").mapInArrow(run, f"doc_id long, score double, n_terms long, evidence {EVIDENCE_DDL}")
    none = F.expr(f"CAST(array() AS {EVIDENCE_DDL})").alias("evidence")
    scored = near.unionByName(bare.select("doc_id", F.lit(model.empty).alias("score"), F.lit(0).cast("long").alias("n_terms"), none))
    held_out = F.coalesce(fold_of(F.col("doc_id")) == held_out_fold, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"), "n_terms", "evidence")
