"""Toxicity by nearest examples: the search against brute force, what is learned, and odd rows."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
from tidemill.llm import toxic_neighbours as T

FILLER = [a + b for a in ("so", "ta", "ri", "len", "mo", "ve") for b in ("n", "ra", "ts", "el", "ing", "o")]
BAD = ["grunk", "splod", "vexor"]


def random_vectors(rng, n, terms):
    idf = 1 + rng.random(terms)
    out = []
    for _ in range(n):
        ids = rng.choice(terms, rng.integers(1, min(6, terms + 1)), replace=False)
        out.append(T.vector({int(i): int(rng.integers(1, 4)) for i in ids}, idf))
    return out, idf


@pytest.mark.parametrize("n,terms,k", [(1, 3, 5), (300, 12, 7), (1000, 60, 25), (130, 5, 200)])
def test_search_is_exact(n, terms, k):
    rng = np.random.default_rng(n)
    vectors, idf = random_vectors(rng, n, terms)
    vectors += vectors[: n // 3]  # ties
    index = T.Index(list(range(len(vectors))), vectors)
    dense = np.zeros((len(vectors), terms))
    for row, (ids, weights) in zip(dense, vectors):
        row[ids] = weights
    for q in [*vectors[:20], *random_vectors(rng, 20, terms)[0]]:
        best, cosines = index.nearest(q, k)
        total = np.zeros(len(vectors))
        for i, w in zip(*(x.tolist() for x in q)):
            total += w * dense[:, i]
        want = [i for i in np.lexsort((np.arange(len(total)), -total)) if total[i] > 0][:k]
        assert best.tolist() == want and cosines.tolist() == total[want].tolist()
    without, _ = index.nearest(vectors[0], k, without=0)
    assert 0 not in without.tolist()


def test_few_blocks_are_worked_out():
    """Bounds let the search stop long before the last block when near examples lie together."""
    idf = np.ones(40)
    vectors = [T.vector({i // 100: 3, 39: 1 + i % 3}, idf) for i in range(3900)]
    index = T.Index(list(range(3900)), vectors)
    index.nearest(vectors[0], 10)
    assert index.opened <= 4 and index.n_blocks == 31


def test_terms_and_vectors():
    counts = T.word_counts("Grunk GRUNKS, das_grunk 12 é!".encode())
    assert counts == Counter({"grunk": 2, "grunks": 1, "das": 1, "é": 1})
    assert T.terms_of("grunks") == ["grunks", "grun*", "grunk*"] and T.terms_of("so") == ["so"]
    known = T.Vocabulary(["grunk", "grunk*"])
    assert known(counts) == {0: 2, 1: 1, 2: 2} and known(Counter({"so": 3})) == {}
    ids, weights = T.vector({0: 2, 2: 2}, np.array([2.0, 1.0, 1.0]))
    assert ids.tolist() == [0, 2] and abs(weights @ weights - 1) < 1e-12 and weights[0] == pytest.approx(2 * weights[1])
    long = ("grunk so " * 300_000).encode()
    assert T.word_counts(long) == Counter({"grunk": 300_000, "so": 300_000})


def test_curve():
    shares, labels = np.array([0.1, 0.2, 0.8, 0.9] * 50), np.array([0, 0, 1, 1] * 50)
    slope, shift = T.fit_curve(shares, labels, np.ones(200))
    assert slope > 1 and abs(shift) < 0.1
    assert T.fit_curve(np.zeros(0), np.zeros(0), np.zeros(0)) == (1.0, 0.0)


def labelled(n=600, seed=4):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(FILLER) + rng.choice(FILLER) for _ in range(rng.randrange(30, 200))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rng.randrange(1, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", "", "s", "ing"]))
        docs.append((i, " ".join(words), i % 6, "x", 1.5))
        labels.append((i, int(toxic), int(toxic)))
    return docs, labels


SHAPE = "doc_id long, text string, label int, term string, score double"


def test_scores(spark):
    docs, labels = labelled()
    odd = [(1000, None, 1, "x", 0.0), (1001, "", 1, "x", 0.0), (None, "a grunk and a splod", 1, "x", 0.0), (7, docs[7][1], 1, "x", 0.0), (1002, "GRUNK! " * 400_000, 1, "x", 0.0)]
    label_rows = [*labels, (None, 1, 1), (3, 1, None), (4, 0, 0), (4, 0, 0), (99_999, 1, 1), (5, 0, 7)]
    table = spark.createDataFrame(docs + odd, SHAPE).repartition(5)
    marks = spark.createDataFrame(label_rows, "doc_id long, quality int, toxic int")
    got = T.toxicity(table, marks).collect()
    assert len(got) == len(docs) + len(odd)
    by = {r.doc_id: r for r in got}
    for r in got:
        held = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2
        assert r.held_out == held and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    assert all(by[i].predicted == t for i, t, _ in labels)
    assert by[1000].score == by[1001].score < 0.1 and by[1000].evidence == [] and by[1000].n_terms == 0
    assert by[None].predicted == 1 and by[1002].predicted == 1 and sum(r.doc_id == 7 for r in got) == 2
    toxic = by[0]
    cosines = [e.cosine for e in toxic.evidence]
    assert len(cosines) == T.EVIDENCE and cosines == sorted(cosines, reverse=True) and all(e.label == 1 for e in toxic.evidence)
    assert all(zlib.crc32(str(e.doc_id).encode()) % 4 != 2 for r in got for e in r.evidence)


def test_held_out_labels_change_nothing(spark):
    docs, labels = labelled(300)
    table = spark.createDataFrame(docs, SHAPE)
    flipped = [(i, 1 - t, 1 - t) if zlib.crc32(str(i).encode()) % 4 == 2 else (i, t, t) for i, t, _ in labels]
    one, two = (T.toxicity(table, spark.createDataFrame(x, "doc_id long, quality int, toxic int")).collect() for x in (labels, flipped))
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))


def test_copies_of_an_example_count_once(spark):
    """A thousand copies of one text with label 1 make none of its words a term."""
    docs, labels = labelled(200)
    docs += [(1000 + i, docs[1][1] + " unusualword", 0, "x", 0.0) for i in range(1000)]
    labels += [(1000 + i, 1, 1) for i in range(1000)]
    train = T.training_labels(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "toxic", 2)
    some = T.examples(spark.createDataFrame(docs, SHAPE), train, 8000)
    assert sum("unusualword" in r.words for r in some.collect()) == 1
    assert "unusualword" not in T.choose_terms(some)


def test_without_labels_or_rows(spark):
    docs, labels = labelled(40)
    table, shape = spark.createDataFrame(docs, SHAPE), "doc_id long, quality int, toxic int"
    assert {(r.score, r.predicted) for r in T.toxicity(table, spark.createDataFrame([], shape)).collect()} == {(0.0, 0)}
    assert T.toxicity(table.limit(0), spark.createDataFrame(labels, shape)).collect() == []
    only = [(i, 0, 0) for i in range(20)]
    assert {r.predicted for r in T.toxicity(table, spark.createDataFrame(only, shape)).collect()} == {0}


def test_query_on_held_out_labels(spark):
    """Held-out documents of the larger table: few clean ones are marked, toxic ones are found."""
    base = "/root/testdata/sf0.1"
    marks = {r.doc_id: r.toxic for r in spark.read.parquet(f"{base}/labels.parquet").collect()}
    got = [r for r in entry.queries()["op11_toxicity"](spark, base).collect() if r.held_out and r.doc_id in marks]
    hit = Counter((marks[r.doc_id], r.predicted) for r in got)
    assert hit[1, 1] / (hit[1, 1] + hit[1, 0]) > 0.9 and hit[0, 1] / (hit[0, 1] + hit[0, 0]) < 0.01
