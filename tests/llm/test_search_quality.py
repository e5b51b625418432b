"""Vector search, quality scores, captures and URL lists on small fixtures."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import one_bit_search as O
from tidemill.llm import quality as Q
from tidemill.llm import revisits as R
from tidemill.llm import url_filters as U

# --- search --------------------------------------------------------------------------------------------


def vectors(n=400, width=32, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, width))
    rows = (centres[rng.integers(0, 6, n)] + 0.5 * rng.standard_normal((n, width))) * rng.uniform(0.2, 3, (n, 1))
    rows[n // 2] = rows[0]  # ties
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rows)]


SHAPE = "vec_id long, embedding array<float>, rank int, block int, score string"


def vector_table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "x") for i, v in rows], SHAPE).repartition(3)


@pytest.mark.parametrize("block,per", [(16_384, 4_096), (50, 7)])
def test_nearest_is_exact_here(spark, monkeypatch, block, per):
    monkeypatch.setattr(O, "BLOCK_ROWS", block)
    monkeypatch.setattr(O, "QUERY_ROWS", per)
    rows = vectors(200)
    odd = [(900, None), (901, []), (902, [0.0] * 32), (903, [float("nan")] * 32), (904, [None, *rows[0][1][1:]]), (905, [1.0] * 5),
           (906, [float("inf"), *rows[0][1][1:]]), (None, rows[0][1]), rows[5]]
    table = vector_table(spark, rows + odd)
    got = O.nearest(table, table.where("vec_id % 20 = 0"), k=9).collect()
    want = O.exact_pairs(rows, [r for r in rows if r[0] % 20 == 0], 9)
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == sorted(want)


def test_nearest_with_few_rows(spark):
    rows = vectors(4)
    table = vector_table(spark, rows)
    got = O.nearest(table, table, k=20).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == sorted(O.exact_pairs(rows, rows, 20))
    assert O.nearest(vector_table(spark, []), vector_table(spark, [])).collect() == []
    assert O.nearest(table, vector_table(spark, [])).collect() == []


def test_recall_by_bound():
    """How often the 20 nearest of 2,000 vectors survive, and how many are worked out exactly."""
    rows = vectors(2000, 64, 3)
    base, turn = np.array([v for _, v in rows]), O.rotation(64)
    codes = O.encode(base, turn)
    assert codes[0].shape == (2000, 8)  # one bit for each component
    for bound, least in ((1.9, 0.9), (4.0, 0.999)):
        hits = picked = 0
        for q in base[::100]:
            middle, error = O.estimates(codes, q, turn, bound)
            high, low = middle + error, np.sort(middle - error)[-20]
            keep = high >= low
            best = np.argsort(-(base @ q))[:20]
            hits += keep[best].sum()
            picked += keep.sum()
        assert hits / (20 * 20) >= least
        assert picked / (20 * 2000) < 0.9


def test_layers_leave_little_to_work_out():
    """Vectors without any structure: codes of four layers send few pairs to the exact stage, and lose none of the 20 nearest."""
    rng = np.random.default_rng(11)
    base, ids, turn = rng.standard_normal((4000, 64)), np.arange(4000)[::-1].copy(), O.rotation(64)
    asked = np.flatnonzero(ids % 20 == 0)
    whole = base[asked] @ base.T
    whole[np.arange(len(asked)), asked] = -np.inf
    shares = {}
    for layers in (1, 4):
        codes = O.encode(base, turn, layers)
        assert codes[0].shape == (4000, 8 * layers)
        found, taken = O.block_best(ids[asked], base[asked], ids, base, codes, 20, O.BOUND, turn)
        got = np.concatenate([f[1] for f in found]).reshape(-1, 20)
        assert np.array_equal(got, ids[np.argsort(-whole, axis=1)[:, :20]])
        shares[layers] = taken / whole.size
    assert shares[4] < 0.08 < 0.5 < shares[1]


def test_query_that_is_no_candidate_and_block_smaller_than_k():
    base, turn = np.random.default_rng(5).standard_normal((6, 16)), O.rotation(16)
    ids, query = np.arange(6) * 3, base[:2] * 2
    found, _ = O.block_best(np.array([0, 100]), query, ids, base, O.encode(base, turn, 2), 20, O.BOUND, turn)
    pairs = [(q, i) for f in found for q, i in zip(f[0].tolist(), f[1].tolist())]
    assert sorted(pairs) == [(0, i) for i in ids[1:]] + [(100, i) for i in ids]


# --- quality -------------------------------------------------------------------------------------------


def labelled(n=400, seed=2):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in ("so", "ta", "ri", "len", "mo") for b in ("n", "ra", "ts", "el", "ing")]
    docs, labels = [], []
    for i in range(n):
        good = rng.random() < 0.8
        text = " ".join(rng.choice(words) for _ in range(rng.randint(5, 80)))
        if not good:
            text = rng.choice([text.upper() + "!!", " ".join(w + "$$$" for w in text.split()), (text.split()[0] + " ") * 40])
        docs.append((i, text))
        if i % 5 < 3:
            labels.append((i, int(good)))
    return docs, labels


def quality_tables(spark, docs, labels):
    d = spark.createDataFrame([(i, t, "en", "s", 0.5, 1) for i, t in docs], "doc_id long, text string, lang string, source string, score double, label int")
    return d.repartition(3), spark.createDataFrame([(i, q, 0) for i, q in labels], "doc_id long, quality int, toxic int")


def test_quality_on_held_out_rows(spark):
    docs, labels = labelled()
    got = {r.doc_id: r for r in Q.quality_scores(*quality_tables(spark, docs, labels)).collect()}
    assert len(got) == len(docs)
    held = [(got[i].score, got[i].predicted, q) for i, q in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i in got)
    assert np.mean([p == q for _, p, q in held]) > 0.95
    assert min(s for s, _, q in held if q) > max(s for s, _, q in held if not q)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())


def test_quality_edges(spark):
    docs, labels = labelled(120)
    odd = [(1000, None), (1001, ""), (None, "some text"), (1002, "x" * 100_000), (5, docs[5][1]), (5, "other")]
    more = [(None, 1), (3, None), (4, 7), (6, 0), (6, 1), (9999, 1), labels[0]]
    d, l = quality_tables(spark, docs + odd, labels + more)
    got = Q.quality_scores(d, l).collect()
    assert len(got) == len(docs) + len(odd) and all(r.score is not None and r.predicted in (0, 1) for r in got)
    kept = Q.keep_good(d, l)
    assert kept.columns == d.columns
    rejected = {r.doc_id for r in got if r.predicted == 0} - {r.doc_id for r in got if r.predicted == 1} - {None}
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in docs + odd} - rejected
    none, _ = quality_tables(spark, [], [])
    assert Q.quality_scores(none, l).collect() == []
    alone = Q.quality_scores(d, l.where("quality = 1")).collect()
    assert all(r.score == pytest.approx(0.7) and r.predicted == 1 for r in alone)


def test_rows_of_one_document_count_once(spark, monkeypatch):
    docs, labels = labelled(120)
    sizes, fit_pairs = [], Q.fit_pairs
    monkeypatch.setattr(Q, "fit_pairs", lambda good, bad, pairs: sizes.append((len(good), len(bad))) or fit_pairs(good, bad, pairs))
    picked = next(i for i, q in labels if zlib.crc32(str(i).encode()) % 4 != 2)
    models = []
    for more in ([], [docs[picked]] * 400):
        d, l = quality_tables(spark, docs + more, labels)
        models.append(Q.fit(d, Q.training_labels(l, "quality", 2)))
    assert sizes[0] == sizes[1] and sum(sizes[0]) == sum(zlib.crc32(str(i).encode()) % 4 != 2 for i, _ in labels)
    assert models[0].weights == pytest.approx(models[1].weights, abs=1e-6)
    d, l = quality_tables(spark, docs + [(picked, "x $$$ !!")], labels)
    assert not np.allclose(Q.fit(d, Q.training_labels(l, "quality", 2)).mean, models[0].mean, rtol=0, atol=1e-9)


def test_pairs_learn_the_order():
    rng = np.random.default_rng(4)
    good, bad = rng.standard_normal((300, Q.WIDTH)), rng.standard_normal((300, Q.WIDTH))
    good[:, 2] += 2.0
    m = Q.fit_pairs(good, bad, 5000)
    assert np.argmax(np.abs(m.weights)) == 2 and m.weights[2] > 0
    again = Q.fit_pairs(good, bad, 5000)
    assert (again.weights == m.weights).all()


# --- captures ------------------------------------------------------------------------------------------

CAPTURE = "capture_id long, url string, fetch_time long, status int, headers map<string,string>, stored int, found string"


def test_revisits(spark):
    rows = [
        (1, "http://www.A.com:80/x/?utm_source=f&a=1#t", 10, 200, {"ETag": '"1"', "Content-Type": "text", "Expires": "mon"}),
        (2, "https://a.com/x?a=1", 20, 304, {"etag": 'W/"1"', "expires": "tue", "Content-Type": "no"}),
        (3, "a.com/x?a=1", 25, 304, {}),  # malformed
        (4, "http://a.com/x?a=1", 30, 304, {"ETag": '"2"'}),
        (5, "http://a.com/x?a=1", 30, 200, {"Last-Modified": "d1"}),
        (6, "http://a.com/x?a=1", 40, 304, {"Last-Modified": "d1"}),
        (7, "http://a.com/x?a=1", 41, 304, {"Last-Modified": "d2"}),
        (8, "http://a.com/x?a=1", 42, 304, None),
        (9, "http://b.com/", 5, 304, {"ETag": '"1"'}),
        (10, "http://b.com", 6, 404, {}),
        (11, None, 7, 304, None), (12, "http://b.com", None, 304, None), (13, "http://b.com/", 8, None, {"A": "1", "a": "2"}),
        (8, "http://a.com/x?a=1", 42, 304, None),
    ]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], CAPTURE).repartition(3)
    got = {(r.capture_id, r.outcome): r for r in R.resolve(df).collect()}
    assert R.resolve(df).count() == len(rows)
    outcome = {k: (o, r.response_id) for (k, o), r in got.items()}
    assert outcome == {
        1: ("response", 1), 2: ("resolved", 1), 3: ("no_response", None), 4: ("mismatch", None), 5: ("response", 5), 6: ("resolved", 5),
        7: ("mismatch", None), 8: ("resolved", 5), 9: ("no_response", None), 10: ("other", None), 11: ("no_response", None),
        12: ("no_response", None), 13: ("other", None),
    }
    assert got[2, "resolved"].headers == {"etag": 'W/"1"', "content-type": "text", "expires": "tue"}
    assert got[2, "resolved"].url == "a.com/x?a=1" and got[13, "other"].headers == {"a": "2"}
    assert R.resolve(df.limit(0)).collect() == []


def test_one_url_with_most_captures(spark):
    rng = random.Random(3)
    rows = [(i, "http://hot.com/" if rng.random() < 0.8 else f"http://c{i % 5}.com/", rng.randint(0, 500),
             rng.choice([200, 304, 304, 304, 404]), {"ETag": rng.choice("ab")}) for i in range(400)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], CAPTURE)
    got = {r.capture_id: (r.outcome, r.response_id) for r in R.resolve(df).collect()}
    last, want = {}, {}
    for i, u, t, s, h in sorted(rows, key=lambda r: (r[2], r[0])):
        if s == 200:
            last[u] = (i, h["ETag"])
            want[i] = ("response", i)
        elif s == 404:
            want[i] = ("other", None)
        elif u not in last:
            want[i] = ("no_response", None)
        else:
            want[i] = ("resolved", last[u][0]) if last[u][1] == h["ETag"] else ("mismatch", None)
    assert got == want


# --- lists ---------------------------------------------------------------------------------------------


def plain_decisions(captures, entries):
    held, keys = [], {}
    for e in entries:
        if None not in e and e[3] in ("add", "remove"):
            keys.setdefault((e[1], e[2].lower()), []).append((e[4], e[0], e[3]))
    for (name, pattern), some in keys.items():
        some.sort()
        for k, (t, i, action) in enumerate(some):
            end = some[k + 1][0] if k + 1 < len(some) else None
            if action == "add" and (end is None or end > t):
                held.append((name, pattern, i, t, end))
    out = []
    for c, url, at in captures:
        hits = []
        if url and "://" in url and at is not None:
            rest = url.split("://")[1].split("#")[0].split("?")[0]
            host, _, path = rest.partition("/")
            host, path = host.lower(), path.rstrip("/")
            for name, p, i, t, end in held:
                full = f"{host}/{path}"
                match = full == p or full.startswith(p + "/") if "/" in p else host == p or host.endswith("." + p)
                if match and t <= at and (end is None or at < end):
                    hits.append((len(p), name == "allow", name, i, p))
        best = max(hits, default=None)
        out.append((c, best[2] if best else "none", best[3] if best else None, best[4] if best else None, len(hits)))
    return sorted(out, key=repr)


ENTRY = "entry_id long, list string, pattern string, action string, entry_time long, start int, found int"


def lists(spark, entries):
    return spark.createDataFrame([(*e, 1, 1) for e in entries], ENTRY)


def test_url_lists(spark):
    rng = random.Random(5)
    hosts = ["a.com", "x.a.com", "y.x.a.com", "b.org", "A.com"]
    entries = [(i, rng.choice(["allow", "block", "ads"]), rng.choice([*hosts, "a.com/p", "x.a.com/p/q", "b.org/p"]),
                rng.choice(["add", "add", "remove"]), rng.randint(0, 40)) for i in range(150)]
    entries += [(None, "block", "a.com", "add", 3), (900, "block", None, "add", 3), (901, "block", "a.com", "keep", 3), entries[0]]
    captures = [(i, f"http://{rng.choice(hosts)}/{rng.choice(['', 'p', 'p/', 'p/q/r?z=1', 'pq', 'p#f'])}", rng.randint(0, 45)) for i in range(200)]
    captures += [(300, None, 5), (301, "nonsense", 5), (302, "http://a.com/", None), (None, "http://a.com/p", 30), captures[0]]
    df = spark.createDataFrame([(*c, 1, 2) for c in captures], "capture_id long, url string, fetch_time long, row int, pattern int").repartition(3)
    got = U.evaluate(df, lists(spark, entries)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_decisions(captures, entries)
    none = U.evaluate(df, lists(spark, [])).collect()
    assert len(none) == len(captures) and {r.decision for r in none} == {"none"}
    assert U.evaluate(df.limit(0), lists(spark, entries)).collect() == []


def test_intervals(spark):
    entries = [(1, "l", "a.com", "add", 5), (2, "l", "A.com ", "add", 9), (3, "l", "a.com", "remove", 12), (4, "l", "b.com", "remove", 1),
               (5, "l", "b.com", "add", 1), (6, "m", "b.com", "add", 2), (7, "m", "b.com", "remove", 2)]
    got = U.validity_intervals(lists(spark, entries)).orderBy("entry_id").collect()
    assert [(r.entry_id, r.valid_from, r.valid_to) for r in got] == [(1, 5, 9), (2, 9, 12), (5, 1, None)]
    assert F is not None
