"""Recommender, graph, spatial and neighbour jobs against brute force."""

import itertools
import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.operators import graph as G
from tidemill.operators import neighbours as N
from tidemill.operators import recommend as C
from tidemill.operators import spatial as P


def _pairs(rows):
    by_user = {}
    for u, i, r in rows:
        by_user.setdefault(u, {})[i] = r
    out = {}
    for items in by_user.values():
        for a, b in itertools.combinations(sorted(items), 2):
            d = out.setdefault((a, b), [0.0, 0, 0.0, 0.0])
            d[0] += items[a] * items[b]
            d[1] += 1
            d[2] += items[a] ** 2
            d[3] += items[b] ** 2
    return out


@pytest.mark.parametrize("text_items", [False, True])
@pytest.mark.parametrize("light,block,group", [(1000, 1024, 10**6), (5, 4, 40), (0, 7, 10**6)])
def test_pair_sums_both_ways(spark, light, block, group, text_items):
    rng = np.random.default_rng(5)
    rows = [(0, i, float(rng.integers(1, 6))) for i in range(30)]  # one user rates everything
    rows += [(u, int(i), float(rng.integers(1, 6))) for u in range(1, 40) for i in rng.choice(30, rng.integers(1, 9), replace=False)]
    if text_items:
        rows = [(u, f"i{i:02d}", r) for u, i, r in rows]
    df = spark.createDataFrame(rows, f"user int, item {'string' if text_items else 'long'}, rating double")
    got = {(r["p1"], r["p2"]): [r["dot"], r["n"], r["s1"], r["s2"]] for r in C.pair_sums(df, light, block, group).collect()}
    assert got == _pairs(rows)


def test_pairs_of_a_hot_item_in_parts(spark):
    rows = [(u, i, float(1 + (u * i) % 5)) for u in range(60) for i in [0, 1 + u % 7, 20 + u % 5, 40 + u % 3]]
    df = spark.createDataFrame([*rows, (None, 1, 2.0), (None, 2, 2.0), (3, None, 1.0)], "user int, item long, rating double")
    found = C._joined_pairs(df, task_pairs=30).collect()
    assert {(r["p1"], r["p2"]): [r["dot"], r["n"], r["s1"], r["s2"]] for r in found} == _pairs(rows) and len(found) == len(_pairs(rows))


def test_golden_cosine(spark):
    rows = [(0, 1, 3), (0, 2, 4), (0, 3, 1), (1, 1, 4), (1, 2, 4), (1, 3, 2)]
    df = C.ratings_of(spark.createDataFrame(rows, "user int, item int, rating int"), "user", "item", "rating")
    got = {(r["p1"], r["p2"]): r["sim"] for r in C.item_similarity(df).collect()}
    norm = {1: 5.0, 2: math.sqrt(32), 3: math.sqrt(5)}
    for (a, b), d in _pairs(rows).items():
        assert got[a, b] == pytest.approx(d[0] / norm[a] / norm[b])


def test_predictions_by_hand(spark):
    rows = [(0, 1, 4.0), (0, 2, 2.0), (7, 1, 5.0)]  # user 0 is an ordinary user
    ratings = spark.createDataFrame(rows, "user int, item int, rating double")
    sims = spark.createDataFrame([(1, 2, 0.5), (1, 3, 0.5), (2, 3, 1.0)], "p1 int, p2 int, sim double")
    got = {(r["user"], r["item"]): r["prediction"] for r in C.predict(ratings, sims).collect()}
    assert got == {(0, 3): pytest.approx((0.5 * 4 + 2) / 1.5), (7, 2): pytest.approx(5.0), (7, 3): pytest.approx(5.0)}
    lists = C.grouped(C.recommend(C.predict(ratings, sims), 2)).collect()
    assert {r["user"]: [x["item"] for x in r["recommendations"]] for r in lists} == {0: [3], 7: [2, 3]}


def test_shuffles_go_after_each_fit(spark, monkeypatch):
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    left, release = [], C.release_shuffles

    def counted(session):
        release(session)
        time.sleep(1)  # the cleaner works beside the driver
        left.append(blocks.getAllBlocks().size())

    monkeypatch.setattr(C, "release_shuffles", counted)
    ratings = spark.createDataFrame([(u, i, float(1 + (u * i) % 5)) for u in range(12) for i in range(10) if (u + i) % 4], "user long, item long, rating double")
    found = C.als_choose(ratings, [2], [0.01, 0.1, 1.0], folds=2, iterations=2).collect()
    assert len(left) == 6 and [r["pairs"] for r in found] == [90] * 3
    assert left[2] <= left[0] + 20 and left[5] <= left[3] + 20  # a fit alone leaves more


def test_rules_agree(spark):
    baskets = {1: "abc", 2: "abc", 3: "ab", 4: "ad", 5: "b", 6: "z"}
    df = spark.createDataFrame([(u, i) for u, s in baskets.items() for i in s], "user int, item string")
    pairs = {(r["antecedent"], r["consequent"]): (r["support"], r["confidence"], r["lift"]) for r in C.pair_rules(df, 0.3, 0.5).collect()}
    assert pairs["c", "a"] == (pytest.approx(2 / 6), pytest.approx(1.0), pytest.approx(1.0 / (4 / 6)))
    full = C.association_rules(df, 0.3, 0.5).collect()
    one = {(r["antecedent"][0], r["consequent"][0]): (r["support"], r["confidence"], r["lift"]) for r in full if len(r["antecedent"]) == 1}
    assert one.keys() == pairs.keys() and all(one[k] == pytest.approx(pairs[k]) for k in one)
    rules = spark.createDataFrame([(["a", "b"], ["c"]), (["d"], ["z"])], "antecedent array<string>, consequent array<string>")
    assert {tuple(r) for r in C.apply_rules(rules, df).collect()} == {(3, "c"), (4, "z")}


def _graph(spark, edges, ids=None):
    ids = ids if ids is not None else sorted({x for e in edges for x in e})
    return spark.createDataFrame([(i,) for i in ids], "id long"), spark.createDataFrame(edges, "src long, dst long")


def test_pagerank(spark):
    edges = [(1, 2), (1, 2), (1, 3), (2, 3), (3, 1), (4, 3), (3, 99)]  # 99 is not a vertex
    v, e = _graph(spark, edges, [1, 2, 3, 4])
    ranks = dict.fromkeys([1, 2, 3, 4], 1.0)
    known = [x for x in edges if x[1] != 99]
    out = {s: sum(a == s for a, _ in known) for s in ranks}
    for _ in range(5):
        ranks = {i: 0.1 + 0.9 * sum(ranks[a] / out[a] for a, b in known if b == i) for i in ranks}
    got = {r["id"]: r["pagerank"] for r in G.pagerank(v, e, normalize=False).collect()}
    assert got == {i: pytest.approx(r) for i, r in ranks.items()}
    assert sum(r["pagerank"] for r in G.pagerank(v, e).collect()) == pytest.approx(4.0)
    assert G.triplets(v, e).count() == 6


def test_paths(spark):
    v, e = _graph(spark, [(1, 2), (1, 3), (2, 4), (3, 4), (4, 5), (2, 5), (5, 6), (1, 2)])
    def paths(source, target):
        return sorted((r["path"], r["length"]) for r in G.shortest_paths(v, e, source, target).collect())

    assert paths("id = 1", "id IN (5, 6)") == [([1, 2, 5], 2)]
    assert paths("id = 1", "id = 4") == [([1, 2, 4], 2), ([1, 3, 4], 2)]
    assert paths("id = 6", "id = 1") == []
    assert paths("id = 6", "id > 4") == [([6], 0)]
    chains = {tuple(r) for r in G.two_hops(v, e, "id = 1", "id = 4").collect()}
    assert chains == {(1, 2, 4, 2), (1, 3, 4, 1)}


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 40)]
    star = [(100, i) for i in range(101, 160)]
    v, e = _graph(spark, chain + star, [*range(1, 41), *range(100, 160), 500])
    got = {r["id"]: r["component"] for r in G.components(v, e).collect()}
    assert all(got[i] == 1 for i in range(1, 41)) and all(got[i] == 100 for i in range(100, 160)) and got[500] == 500


def _km(a, b):
    p, q = math.radians(a[2]), math.radians(b[2])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(h))


@pytest.mark.parametrize("budget", [10, 100_000])
@pytest.mark.parametrize("farthest", [False, True])
def test_extreme_pairs(spark, farthest, budget):
    rng = np.random.default_rng(8)
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate(zip(rng.uniform(-170, 170, 120), rng.uniform(-80, 80, 120)))]
    pts += [(1000 + i, 10.0, 10.0) for i in range(40)]  # a third at one place
    df = spark.createDataFrame(pts, "id long, lon double, lat double")
    want = sorted(((round(_km(a, b), 6), a[0], b[0]) for a, b in itertools.combinations(pts, 2)), key=lambda r: (-r[0] if farthest else r[0], r[1], r[2]))[:10]
    got = [(r["km"], r["id1"], r["id2"]) for r in P.extreme_pairs(df, "id", "lon", "lat", 10, farthest, budget).collect()]
    assert [(pytest.approx(k, abs=2e-6), a, b) for k, a, b in want] == got


def test_zones(spark):
    zones = spark.createDataFrame(
        [(1, [[(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0)]]), (2, [[(1.0, 1.0), (3.0, 1.0), (3.0, 3.0), (1.0, 3.0), (1.0, 1.0)]])],
        "zone int, rings array<array<struct<x: double, y: double>>>",
    )
    pts = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.5, 1.5), (3, 2.5, 2.5), (4, 2.0, 0.5), (5, 9.0, 9.0)], "id int, x double, y double")
    got = {r["id"]: r["zone"] for r in P.zone_of(pts, zones, "id", "zone", "x", "y", 0.7).collect()}
    assert got == {1: 1, 2: 1, 3: 2, 4: None, 5: None}
    assert P.zone_matches(pts, zones, "zone", "x", "y", 0.7).count() == 4


@pytest.mark.parametrize("cells,chunk", [(1, 10**6), (8, 25), (40, 7)])
def test_nearest(spark, cells, chunk):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(150, 4)).round(2)
    x[:50] = x[0]  # a third are copies
    q = np.vstack([rng.normal(size=(30, 4)), x[:5]])
    train = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(x)], "id long, vec array<double>, label int")
    query = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "id long, vec array<double>")
    got = {}
    near = N.nearest(train, query, 4, cells, chunk)
    for r in near.collect():
        got.setdefault(r["query_id"], []).append((r["rn"], r["id"]))
    for i, v in enumerate(q):
        d = np.round(np.sqrt(((x - v) ** 2).sum(1)), 9)
        assert [j for _, j in sorted(got[i])] == list(np.lexsort((np.arange(150), d))[:4])
    assert N.vote(near, train).count() == len(q)


@pytest.mark.parametrize("budget", [0, 100_000])
def test_density_clusters(spark, budget):
    rng = np.random.default_rng(4)
    blob = rng.normal([0, 0], 0.05, (120, 2))  # a crowded place
    pts = np.vstack([blob, rng.uniform(-1, 1, (120, 2)), np.tile([[0.9, 0.9]], (30, 1)), [[5.0, 5.0]]])
    eps, least = 0.11, 5
    near = ((pts[:, None] - pts[None]) ** 2).sum(2) <= eps * eps
    core = near.sum(1) >= least
    want = np.full(len(pts), -1)
    for i in np.nonzero(core)[0]:
        if want[i] < 0:
            todo = [i]
            while todo:
                j = todo.pop()
                if want[j] < 0:
                    want[j] = i
                    todo += [k for k in np.nonzero(near[j] & core)[0] if want[k] < 0]
    for i in np.nonzero(~core)[0]:
        around = want[near[i] & core]
        want[i] = around.min() if len(around) else -1
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "id long, x double, y double")
    got = {r["id"]: r["cluster"] for r in N.density_clusters(df, eps, least, budget=budget).collect()}
    assert got == {i: int(c) for i, c in enumerate(want)}


def test_recommendations_of_every_user(spark):
    """Query ``als_recommend_all`` against all products of the fitted factors."""
    from tidemill.plans import recommend as P
    from tidemill.sources.tables import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    ratings = P._ratings(t)
    factors = P.C.als_fit(ratings, rank=10, reg=0.1, iterations=10)
    sides = []
    for ids, rows, key in ((factors.users, factors.model.userFactors, "user"), (factors.items, factors.model.itemFactors, "item")):
        names = {r[f"{key}_id"]: r[key] for r in ids.collect()}
        sides.append({names[r.id]: np.array(r.features) for r in rows.collect()})
    items = list(sides[1])
    table = np.array([sides[1][i] for i in items])
    scores = {u: dict(zip(items, (table @ v).tolist())) for u, v in sides[0].items()}
    out = P.als_recommend_all(t)
    assert out.columns == ["user", "pos", "item", "rating"]
    found = {}
    for r in out.collect():
        found.setdefault(r.user, []).append((r.pos, r.item, r.rating))
    assert set(found) == set(scores) == {r.user for r in ratings.select("user").distinct().collect()}
    for u, rows in found.items():
        rows.sort()
        best = sorted(scores[u].values(), reverse=True)[:5]
        assert [p for p, _, _ in rows] == list(range(len(best))) and len({i for _, i, _ in rows}) == len(best)
        assert [x for _, _, x in rows] == pytest.approx(best, abs=1e-3)
        assert [x for _, _, x in rows] == pytest.approx([scores[u][i] for _, i, _ in rows], abs=1e-3)


def test_grid_of_the_factorisation(spark, monkeypatch):
    from tidemill.plans import recommend as P
    from tidemill.sources.tables import Tables

    monkeypatch.setattr(P.C, "als_choose", lambda ratings, ranks, regs, folds: (ranks, regs, folds))
    assert P.als_grid(Tables(spark, "/root/testdata/sf0.001")) == ([5, 10, 15], [0.001, 0.01, 0.1, 1.0, 10.0], 4)


def test_error_of_the_factorisation(spark, monkeypatch):
    from tidemill.plans import recommend as P
    from tidemill.sources.tables import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    kept, predict = [], P.C.als_predict
    monkeypatch.setattr(P.C, "als_predict", lambda factors, test: kept.append((factors.mean, predict(factors, test))) or kept[-1][1])
    row = P.als_error(t).first()
    mean, scored = kept[0][0], kept[0][1].collect()
    off = lambda guess: math.sqrt(np.mean([(r.rating - guess(r)) ** 2 for r in scored]))
    rmse, base = off(lambda r: r.prediction), off(lambda r: mean)
    assert (row.pairs, row.beats_baseline) == (len(scored), rmse < base)
    assert (row.rmse, row.mean_rmse) == (pytest.approx(rmse, abs=1e-5), pytest.approx(base, abs=1e-5))
