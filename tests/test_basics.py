"""Small fixtures with known results for the relational, text and review functions."""

import json

import pytest
from pyspark.sql import functions as F

from tidemill.functions import text as X
from tidemill.functions import udfs, urls
from tidemill.operators import aggregates as A
from tidemill.operators import features as M
from tidemill.operators import relational as R
from tidemill.operators import reviews as V
from tidemill.operators import sampling as S
from tidemill.operators import windows as W
from tidemill.sources import files, sinks

PERSON = "Id int, Name string, City string, Year int, Grade int, Gender string"
PERSONS = """0,Dima,Moscow,1988,4,m
1,Sveta,Kiev,1999,4,f
2,Alex,Minsk,1954,null,m
3,Ivan,St.Petersburg,2005,6,m
4,Kate,London,2001,null,f
5,Lea,Tel-Aviv,1998,,f
"""
MORE = """6,John,Moscow,1928,4,m
1,Sveta,Kiev,1999,4,f
8,Natan,Los Angeles,1988,null,m
"""
ITEMS = [(0, "TV"), (1, "Smartphone"), (2, "TV"), (3, "Pendrive"), (4, "TV"), (5, "PC"), (6, "PC"), (1, "PC"), (2, "Laptop")]


@pytest.fixture(scope="module")
def persons(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("csv")
    (path / "persons.csv").write_text(PERSONS)
    (path / "more.csv").write_text(MORE)
    return files.read_csv(spark, str(path / "persons.csv"), PERSON), files.read_csv(spark, str(path / "more.csv"), PERSON)


@pytest.fixture(scope="module")
def items(spark):
    return files.from_rows(spark, ITEMS, "Id int, Item string", partitions=3)


def test_csv_nulls(persons):
    p, _ = persons
    assert {r["Id"] for r in p.where("Grade IS NULL").collect()} == {2, 4, 5}
    assert R.null_counts(p).first()["Grade"] == 3
    assert "Grade" not in R.drop_null_columns(p).columns


def test_malformed_rows_dropped_and_inferred(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Id,Grade\n1,5\nx,7\n2,6\n")
    fixed = files.read_csv(spark, str(tmp_path / "a.csv"), "Id int, Grade int", header=True)
    assert [tuple(r) for r in fixed.collect()] == [(1, 5), (2, 6)]
    (tmp_path / "b.csv").write_text("Id,Grade\n1,5.5\n2,6\n")
    assert files.read_csv(spark, str(tmp_path / "b.csv"), header=True).dtypes == [("Id", "int"), ("Grade", "double")]


def test_grades_null_rules(persons):
    p, _ = persons
    got = {r["Id"]: (r["big"], r["raw"], r["filled"]) for r in p.select(
        "Id",
        F.when(F.col("Grade") > 4, True).otherwise(False).alias("big"),
        udfs.letter("Grade", 5).alias("raw"),
        udfs.letter(F.coalesce("Grade", F.lit(0)), 5).alias("filled"),
    ).collect()}
    assert got[2] == (False, "A", "F") and got[3] == (True, "A", "A") and got[0] == (False, "F", "F")
    rows = p.select("Id", udfs.letter_row("Grade").alias("g"))
    assert {r["g"] for r in rows.where("Id in (2, 4, 5)").collect()} == {"F"}


def test_sets(persons):
    p, m = persons
    ids = lambda df: sorted(r["Id"] for r in df.collect())
    assert ids(p.union(m)) == [0, 1, 1, 2, 3, 4, 5, 6, 8]
    assert ids(R.union_distinct(p, m)) == [0, 1, 2, 3, 4, 5, 6, 8]
    assert ids(R.intersect(p, m)) == [1]
    assert ids(R.subtract(p, m)) == [0, 2, 3, 4, 5] and ids(R.subtract(m, p)) == [6, 8]


@pytest.mark.parametrize("how", ["left", "right", "full"])
def test_outer_joins_match_builtin(persons, items, how):
    p = persons[0].select("Id", "Name").where("Id <> 4")
    got = sorted(map(str, R.outer_join(p, items, "Id", how).collect()))
    want = sorted(map(str, p.join(items, "Id", how).select("Id", "Name", "Item").collect()))
    assert got == want


def test_cogroup_pieces(spark):
    left = spark.createDataFrame([(1, i) for i in range(7)] + [(4, 1)], "k int, v int")
    right = spark.createDataFrame([(1, "x"), (5, "y")], "k int, w string")
    got = {(r["k"], r["piece"]): (r["left_values"], r["right_values"]) for r in R.cogroup_lists(left, right, "k", "v", "w", chunk=3).collect()}
    assert got == {
        (1, 0): ([0, 1, 2], ["x"]), (1, 1): ([3, 4, 5], []), (1, 2): ([6], []), (4, 0): ([1], []), (5, 0): ([], ["y"]),
    }


def test_rank_keeps_ties_and_top_n_does_not(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([5.0, 5.0, 4.0, 4.0, 3.0])], "k string, id int, v double")
    ranks = sorted((r["rank"], r["id"]) for r in W.rank_per_group(df, ["k"], "v", 3).collect())
    assert ranks == [(1, 0), (1, 1), (3, 2), (3, 3)]
    top = W.top_per_group(df, ["k"], [F.desc("v"), F.asc("id")], 3)
    assert sorted(r["id"] for r in top.collect()) == [0, 1, 2]


def test_word_counts(spark):
    df = spark.createDataFrame([("a a b c d",)], "t string")
    assert {r["word"]: r["cnt"] for r in X.word_count(df, X.whitespace_tokens("t")).collect()} == {"a": 2, "b": 1, "c": 1, "d": 1}
    gaps = spark.createDataFrame([("  a  b ",), ("",)], "t string")
    count = lambda tokens: {r["word"]: r["cnt"] for r in X.word_count(gaps, tokens).collect()}
    assert count(X.whitespace_tokens("t")) == {"a": 1, "b": 1}
    assert count(X.space_tokens("t")) == {"": 5, "a": 1, "b": 1}
    assert count(X.space_tokens("t", drop_trailing=True)) == {"": 3, "a": 1, "b": 1}


def test_text_functions(spark):
    df = spark.createDataFrame([("Вчера Маша и Сергей видели Анну. Потом пришел Андрей, и Ия",)], "t string")
    got = df.select(X.proper_nouns(X.whitespace_tokens("t")).alias("n")).first()["n"]
    assert got == ["Маш", "Серг", "Анн", "Андр", "И"]
    grams = spark.createDataFrame([("one two three",), ("one",), ("",)], "t string")
    assert [r["g"] for r in grams.select(X.bigrams(X.letter_tokens("t")).alias("g")).collect()] == [["one two", "two three"], [], []]


REVIEWS = [5.0, 1.0, 3.0, 2.0, 1.0]


def test_review_jobs(spark, tmp_path):
    lines = [json.dumps({"asin": "0528881469", "overall": r, "reviewText": "x", "extra": 1}) for r in REVIEWS]
    (tmp_path / "r.json").write_text("\n".join([*lines, "not json", '{"asin": "z"}']))
    raw = files.read_lines(spark, str(tmp_path / "r.json"))
    assert V.parse_states(raw, files.REVIEW, ["asin", "overall"]).first().asDict() == {"bad_json": 1, "missing_value": 1, "correct": 5}
    parsed = files.parse_json(raw)
    assert parsed.count() == 6
    whole = files.read_reviews(spark, str(tmp_path / "r.json")).where("overall IS NOT NULL")
    assert A.average_by_key(whole, "asin", "overall").first()["avg_value"] == pytest.approx(2.4)
    hist = [(r["overall"], r["cnt"]) for r in V.rating_histogram(whole, "asin", "overall").collect()]
    assert hist == [(1.0, 2), (2.0, 1), (3.0, 1), (5.0, 1)]
    assert tuple(V.max_and_count(whole, "asin", "overall").first())[1:] == (5.0, 5)


def test_rating_intervals(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (1.5,), (3.0,), (3.5,), (4.0,), (4.5,)], "r double")
    assert [r[0] for r in df.select(V.rating_interval("r")).collect()] == ["1", "1", "2", "3", "4", "4", "5"]
    assert [r[0] for r in df.select(V.rating_interval("r", legacy_labels=True)).collect()] == ["1", "1", "2", "3", "3", "3", "5"]


def test_urls(spark):
    from urllib.parse import urlparse

    texts = [
        "http://a.b.example.com:8080/x/y.html;v=1?q=1&r=2#top", "example.org/path", "10.0.0.1:99/a%20b", "https://h", "//host/p?x",
        "HTTP://Up.example/%7e", "host?only=query",
    ]
    df = spark.createDataFrame([(u,) for u in texts], "url string")
    got = {r["url"]: r for r in df.select("url", *[c.alias(n) for n, c in urls.parts("url").items()]).collect()}
    for u in texts:
        want = urlparse(u if "//" in u else "//" + u)
        assert tuple(got[u][n] for n in ("scheme", "netloc", "path", "params", "query", "fragment")) == tuple(want), u
    feats = {r["url"]: r for r in df.select("url", *[c.alias(n) for n, c in urls.features("url").items()]).collect()}
    assert feats[texts[2]]["is_ip"] == 1 and feats[texts[2]]["count_percent"] == 1 and feats[texts[0]]["has_port"] == 1
    assert feats[texts[0]]["domain_level"] == 4 and feats[texts[0]]["num_query_params"] == 1


def test_sections(spark, tmp_path):
    (tmp_path / "one.txt").write_text("1:\n10,5\n11,4\n2:\n10,3\n")
    (tmp_path / "two.txt").write_text("3:\n\n12,1\n")
    got = files.read_sections(spark, str(tmp_path), "user int, rating int")
    assert sorted(tuple(r) for r in got.collect()) == [(1, 10, 5), (1, 11, 4), (2, 10, 3), (3, 12, 1)]


def test_geojson(spark, tmp_path):
    square = [[[[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]], [[0.5, 0.5], [1, 0.5], [1, 1]]]]
    doc = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"zone": "z", "n": 7}, "geometry": {"type": "MultiPolygon", "coordinates": square}}]}
    (tmp_path / "z.json").write_text(json.dumps(doc, indent=1))
    row = files.read_zones(spark, str(tmp_path / "z.json"), "zone: string, n: int").first()
    assert (row["zone"], row["n"], len(row["rings"]), len(row["rings"][0])) == ("z", 7, 1, 5)


def test_labelled_text_keeps_quotes(spark, tmp_path):
    (tmp_path / "s.tsv").write_text('ham\tsay "hi" there\nspam\t"win\n')
    assert [tuple(r) for r in files.read_labelled_text(spark, str(tmp_path / "s.tsv")).collect()] == [("ham", 'say "hi" there'), ("spam", '"win')]


def test_pairs_sink_and_images(spark, tmp_path):
    df = spark.createDataFrame([("a", 2), ("b", 1)], "k string, v int")
    sinks.write_pairs(df, str(tmp_path / "o"), "k", "v")
    assert sorted(r["value"] for r in files.read_lines(spark, str(tmp_path / "o") + "/part*").collect()) == ["a\t2", "b\t1"]
    image = files.from_images(spark, [(3, [0, 0.5], "f.png")])
    assert image.dtypes == [("label", "int"), ("image", "array<float>"), ("filename", "string")] and image.first()["image"] == [0.0, 0.5]


def test_fill_and_mode(spark):
    df = spark.createDataFrame([(1.0, "x"), (None, "y"), (3.0, None), (8.0, "y")], "a double, b string")
    assert [r["a"] for r in R.fill_with_statistic(df, ["a"], "median").collect()] == [1.0, 3.0, 3.0, 8.0]
    assert [r["b"] for r in R.fill_with_mode(df, ["b"]).collect()] == ["x", "y", "y", "y"]


def test_splits_are_disjoint_and_whole(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    parts = S.split(df, "k", [0.5, 0.3, 0.2], 4)
    sizes = [p.count() for p in parts]
    assert sum(sizes) == 2000 and all(abs(n - w * 2000) < 120 for n, w in zip(sizes, [0.5, 0.3, 0.2]))
    assert S.take_sample(df, "k", 17, 5).count() == 17
    one = {r["k"] for r in S.sample(df, "k", 0.2, 9).collect()}
    assert one == {r["k"] for r in S.sample(df.repartition(7), "k", 0.2, 9).collect()}
    copies = S.sample(df, "k", 1.0, 9, with_replacement=True).count()
    assert abs(copies - 2000) < 200


def test_gradient_and_least_squares_agree(spark):
    df = spark.createDataFrame([(float(x), 2.0 + 3.0 * x) for x in (-1, 0, 1, 2)], "x double, y double")
    exact = {r["term"]: r["coefficient"] for r in M.least_squares(df, ["x"], "y").collect()}
    assert exact == {"intercept": pytest.approx(2.0), "x": pytest.approx(3.0)}
    close = {r["term"]: r["weight"] for r in M.descend(df, ["x"], "y", 0.3, 80).collect()}
    assert close == {"intercept": pytest.approx(2.0, abs=1e-3), "x": pytest.approx(3.0, abs=1e-3)}


def test_ridge_grid_matches_numpy(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x = rng.normal(size=(120, 2))
    y = x @ [1.5, -2.0] + 0.5 + rng.normal(size=120)
    df = spark.createDataFrame([(i, float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))], "k int, a double, b double, y double")
    folds = {r["k"]: r["fold"] for r in S.folds(df, "k", 4, 2).collect()}
    fold = np.array([folds[i] for i in range(120)])
    for r in M.ridge_grid(df, ["a", "b"], "y", [0.0, 5.0], 4, "k", 2).collect():
        sse = 0.0
        for f in range(4):
            z = np.c_[np.ones(120), x]
            t = fold != f
            beta = np.linalg.solve(z[t].T @ z[t] + r["strength"] * np.diag([0, 1, 1]), z[t].T @ y[t])
            sse += ((y[~t] - z[~t] @ beta) ** 2).sum()
        assert r["rmse"] == pytest.approx(np.sqrt(sse / 120))
