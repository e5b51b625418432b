"""Inverted lists and top products against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemill.operators import top_products as P
from tidemill.operators import vector_index as V
from tidemill.operators.windows import top_per_group


def clustered(n, width, seed, centres=30):
    rng = np.random.default_rng(seed)
    c = rng.standard_normal((centres, width)) * 3
    return c[rng.integers(0, centres, n)] + rng.standard_normal((n, width)) * 0.4


def table(spark, rows, first=0, name="id"):
    return spark.createDataFrame([(first + i, [float(x) for x in v]) for i, v in enumerate(rows)], f"{name} long, vec array<double>")


def plain(train, query, k):
    out = {}
    for i, q in enumerate(query):
        d = np.round(np.sqrt(((train - q) ** 2).sum(1)), 9)
        out[i] = [(int(j), d[j]) for j in np.lexsort((np.arange(len(d)), d))[:k]]
    return out


def recall_of(got, want):
    found = {}
    for r in got:
        found.setdefault(r.query_id, {})[r.id] = r.distance
    for q, rows in found.items():
        assert all(v == pytest.approx(dict(want[q])[i], abs=1e-9) for i, v in rows.items() if i in dict(want[q]))
    return np.mean([len(set(found.get(q, {})) & {i for i, _ in rows}) / len(rows) for q, rows in want.items()])


def test_clustered_vectors_need_few_cells(spark):
    x = clustered(4000, 24, 1)
    index = V.build(table(spark, x[:3800]), 5)
    got = V.search(index, table(spark, x[3800:]), 5).collect()
    assert recall_of(got, plain(x[:3800], x[3800:], 5)) >= 0.95
    assert index.probes <= len(index.sizes) / 4 and index.sizes.sum() == 3800
    assert max(r.rn for r in got) == 5


def test_vectors_without_structure(spark):
    """Most cells are looked into, but under a tenth of the rows is worked out exactly."""
    x = np.random.default_rng(2).standard_normal((3100, 32))
    index = V.build(table(spark, x[:3000]), 5)
    found = V.search(index, table(spark, x[3000:]), 5)
    assert recall_of(found.collect(), plain(x[:3000], x[3000:], 5)) >= 0.9
    row = V.report(index, table(spark, x[3000:]), found, found, 5).first()
    assert row.exact_share < 0.1 and row.recall == 1 and row.queries == 100


def test_hot_cells_are_cut(spark, monkeypatch):
    """A third of the rows and queries in one place; pieces and parts are smaller than a cell."""
    monkeypatch.setattr(V, "CHUNK", 50)
    x = np.concatenate([np.zeros((400, 8)), clustered(800, 8, 3)])
    index = V.build(table(spark, x), 4)
    q = np.concatenate([np.zeros((120, 8)), x[500:600]])
    got = V.search(index, table(spark, q), 4).collect()
    want = plain(x, q, 4)
    assert len(got) == 4 * len(q)
    for r in got:
        assert r.distance == pytest.approx(want[r.query_id][r.rn - 1][1], abs=1e-6) or r.query_id >= 120
    assert index.codes.select("cell", "piece").distinct().count() > len(index.sizes)


def test_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (3, []), (4, [float("nan"), 1.0]), (5, [1.0, None]), (6, [2.0, 0.0]), (7, [1.0, 2.0, 3.0]), (8, [float("inf"), 0.0])]
    odd = spark.createDataFrame(rows, "id long, vec array<double>")
    index = V.build(odd, 3)
    got = V.search(index, odd, 3).collect()
    assert {(r.query_id, r.id) for r in got} == {(1, 1), (1, 6), (6, 1), (6, 6)}
    assert V.build(odd.where("id = 2"), 3) is None
    assert V.search(index, odd.limit(0), 3).collect() == []
    assert [r.id for r in V.search(V.build(odd.where("id = 1"), 3), odd, 3).where("query_id = 6").collect()] == [1]


def test_queries_of_the_index(spark):
    base = "/root/testdata/sf0.1"
    row = entry.queries()["knn_index_report"](spark, base).first()
    assert row.exact_share < 0.1 and row.recall >= 0.9 and row["rows"] + row.queries == 2000
    near = {r.query_id: r.label for r in entry.queries()["knn_index"](spark, base).collect()}
    true = {r.query_id: r.label for r in entry.queries()["knn_vote"](spark, base).collect()}
    assert set(near) == set(true) and np.mean([near[i] == true[i] for i in true]) > 0.9


# --- inner products ------------------------------------------------------------------------------------


def products(spark, users, items, top, **kw):
    found = P.top_products(table(spark, users, name="user"), table(spark, items, name="item"), top, **kw)
    got = {}
    for r in found.rows.collect():
        got.setdefault(r.user, []).append((r.rn, r.item, r.score))
    score = np.zeros((len(users), len(items)))
    for d in range(users.shape[1]):
        score += users[:, d, None] * items[None, :, d]
    for u, own in enumerate(score):
        order = np.lexsort((np.arange(len(items)), -own))[:top]
        assert [(i, s) for _, i, s in sorted(got[u])] == [(int(i), own[i]) for i in order]
    return found


@pytest.mark.parametrize("top", [1, 5, 40])
def test_top_products_equal_all_products(spark, top):
    rng = np.random.default_rng(top)
    users = rng.standard_normal((90, 6))
    items = rng.standard_normal((1500, 6)) * rng.lognormal(0, 1, (1500, 1))
    items[700:720] = items[3]  # ties
    found = products(spark, users, items, top, first=16)
    assert found.pairs == 90 * 1500 and found.products < found.pairs / 2


def test_top_products_of_equal_lengths(spark):
    """Without any falling length nothing can be left out, and nothing is lost."""
    rng = np.random.default_rng(9)
    users, items = rng.standard_normal((20, 4)), rng.standard_normal((300, 4))
    items /= np.sqrt((items**2).sum(1, keepdims=True))
    users[3] = 0
    assert products(spark, users, items, 7, first=10).products <= 1.5 * 20 * 300  # bounds add to it


def test_top_products_edges(spark, monkeypatch):
    monkeypatch.setattr(P, "ITEMS", 7)
    monkeypatch.setattr(P, "USERS", 9)
    rng = np.random.default_rng(4)
    products(spark, rng.standard_normal((30, 3)), rng.standard_normal((60, 3)), 4, first=32)
    few = table(spark, rng.standard_normal((2, 3)), name="item")
    users = table(spark, rng.standard_normal((3, 3)), name="user").unionByName(spark.createDataFrame([(9, None)], "user long, vec array<double>"))
    assert P.top_products(users, few, 5).rows.groupBy("user").count().where(F.col("count") == 2).count() == 3
    assert P.top_products(users, few.limit(0), 5).rows.collect() == [] == P.top_products(users.limit(0), few, 5).rows.collect()
    named = spark.createDataFrame([("b", [1.0]), ("a", [1.0]), ("c", [2.0])], "item string, vec array<double>")
    one = spark.createDataFrame([("u", [1.0])], "user string, vec array<double>")
    assert [r.item for r in P.top_products(one, named, 2).rows.orderBy("rn").collect()] == ["c", "a"]


def test_products_of_fitted_factors(spark):
    row = entry.queries()["als_recommend_cost"](spark, "/root/testdata/sf0.01").first()
    assert row.products < 0.5 * row.pairs and row["rows"] == 5 * row.users


def test_queries_are_sent_to_blocks_of_cells(spark, monkeypatch):
    """A query that looks into all cells is sent once to each block, and a task gives back ``refine`` rows for it, however many its cells are."""
    monkeypatch.setattr(V, "CHUNK", 300)
    monkeypatch.setattr(V, "ASKED", 40)
    returned = []
    monkeypatch.setattr(V, "top_per_group", lambda df, *a: returned.append(df.count()) or top_per_group(df, *a))
    x = np.random.default_rng(6).standard_normal((1200, 8))
    x[1100:1150] = x[7]  # equal codes
    index = V.build(table(spark, x[:1150]), 3, cells=30)
    index = index._replace(probes=30)
    got = V.shortlist(index, table(spark, x[1100:], name="query_id"), 20).collect()
    blocks = int(V._blocks(index.sizes).max()) + 1
    assert blocks < 10 and returned == [100 * 20 * blocks]
    code = {r.id: np.frombuffer(r.code, dtype=np.uint8) for r in index.codes.collect()}
    for name in (0, 70):
        table_of = index.model.tables(x[1100 + name])
        near = sorted(code, key=lambda i: (sum(t[c] for t, c in zip(table_of, code[i])), i))[:20]
        assert sorted(r.id for r in got if r.query_id == name) == sorted(near)


def test_batches_to_cells_are_small(spark, monkeypatch):
    """Visits go out in batches of bounded size, whatever the number of cells, and rows are held in blocks; results are those of all pairs."""
    from tidemill.operators import neighbours as N

    sizes = []
    real = N._squares
    monkeypatch.setattr(N, "SENT", 100)
    monkeypatch.setattr(N, "HELD", 400)
    monkeypatch.setattr(N, "_squares", lambda a, b: sizes.append(len(a)) or real(a, b))
    x = np.random.default_rng(8).standard_normal((260, 6))
    query = table(spark, x[200:])
    plans = []
    whole = type(query).mapInPandas
    monkeypatch.setattr(type(query), "mapInPandas", lambda df, f, schema: plans.append(f) or whole(df, f, schema))
    got = N.nearest(table(spark, x[:200]), query, 3, cells=20).collect()
    want = plain(x[:200], x[200:], 3)
    assert [(r.id, r.distance) for r in sorted(got, key=lambda r: (r.query_id, r.rn))] == [p for q in range(60) for p in want[q]]
    import pandas as pd

    batch = pd.DataFrame({"query_id": range(60), "vec": list(x[200:]), "bound": [float("nan")] * 60})
    out = list(plans[2](iter([batch])))
    assert max(len(b) for b in out) <= 100 and sum(len(b) for b in out) > 100
