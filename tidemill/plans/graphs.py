"""Graph queries on a trade graph: customers buy parts, suppliers supply them, returned goods are refunded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import graph as G
from ..session import cut_lineage
from ..sources.tables import Tables
from .registry import job

GRAPH = """v AS (SELECT 'C' || c_custkey AS id, c_nationkey AS nation FROM customer
 UNION ALL SELECT 'P' || p_partkey, NULL FROM part UNION ALL SELECT 'S' || s_suppkey, s_nationkey FROM supplier),
 x AS (SELECT 'C' || o_custkey AS c, 'P' || l_partkey AS p, 'S' || l_suppkey AS s, l_returnflag AS f FROM lineitem
 JOIN orders ON l_orderkey = o_orderkey),
 e AS (SELECT c AS src, p AS dst, 'bought' AS kind FROM x UNION ALL SELECT p, s, 'supplied' FROM x
 UNION ALL SELECT s, c, 'refunded' FROM x WHERE f = 'R')"""


def _vertices(t: Tables) -> DataFrame:
    def named(df: DataFrame, letter: str, key: str, nation) -> DataFrame:
        return df.select(F.concat(F.lit(letter), F.col(key).cast("string")).alias("id"), nation.alias("nation"))

    return (
        named(t.customer, "C", "c_custkey", F.col("c_nationkey"))
        .unionByName(named(t.part, "P", "p_partkey", F.lit(None).cast("int")))
        .unionByName(named(t.supplier, "S", "s_suppkey", F.col("s_nationkey")))
    )


def _edges(t: Tables) -> DataFrame:
    rows = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag").join(
        t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    c, p, s = (
        F.concat(F.lit(letter), F.col(key).cast("string"))
        for letter, key in (("C", "o_custkey"), ("P", "l_partkey"), ("S", "l_suppkey"))
    )
    # One pass over the join: each row fans out to its two or three edges.
    edge = lambda a, b, kind: F.struct(a.alias("src"), b.alias("dst"), F.lit(kind).alias("kind"))
    fan = F.array(edge(c, p, "bought"), edge(p, s, "supplied"))
    fan = F.when(F.col("l_returnflag") == "R", F.array_append(fan, edge(s, c, "refunded"))).otherwise(fan)
    return rows.select(F.explode(fan).alias("e")).select("e.*")


@job(
    "triplets",
    f"""WITH {GRAPH} SELECT a.nation AS src_nation, kind, b.nation AS dst_nation, count(*) AS cnt FROM e
    JOIN v a ON a.id = src JOIN v b ON b.id = dst GROUP BY ALL""",
)
def triplets(t: Tables) -> DataFrame:
    """Triplets view, summarised by the attributes of both ends."""
    rows = G.triplets(_vertices(t), _edges(t))
    return rows.groupBy(
        F.col("src.nation").alias("src_nation"), F.col("edge.kind").alias("kind"), F.col("dst.nation").alias("dst_nation")
    ).agg(F.count(F.lit(1)).alias("cnt"))


@job(
    "degrees",
    f"""WITH {GRAPH}, i AS (SELECT dst AS id, count(*) AS in_degree FROM e GROUP BY 1),
    o AS (SELECT src AS id, count(*) AS out_degree FROM e GROUP BY 1)
    SELECT id, in_degree, out_degree FROM i JOIN o USING (id)""",
)
def degrees(t: Tables) -> DataFrame:
    """In- and out-degree joined on the vertex."""
    e = cut_lineage(_edges(t))
    return G.degrees(e, "dst", "in_degree").join(G.degrees(e, "src", "out_degree"), "id")


def _rank_sql(steps: int) -> str:
    parts = [
        "w AS (SELECT src, dst, count(*) AS w FROM e WHERE src IN (SELECT id FROM v) AND dst IN (SELECT id FROM v) GROUP BY ALL)",
        "f AS (SELECT src, dst, w / sum(w) OVER (PARTITION BY src) AS p FROM w)",
        "r0 AS (SELECT id, CAST(1 AS DOUBLE) AS r FROM v)",
    ]
    for i in range(1, steps + 1):
        parts.append(
            f"r{i} AS (SELECT id, 0.1 + 0.9 * coalesce(g, 0) AS r FROM v LEFT JOIN (SELECT dst, sum(r * p) AS g FROM f "
            f"JOIN r{i - 1} ON id = src GROUP BY 1) ON dst = id)"
        )
    return ", ".join(parts)


@job("pagerank_raw", f"WITH {GRAPH}, {_rank_sql(5)} SELECT id, round(r, 6) AS pagerank FROM r5")
def pagerank_raw(t: Tables) -> DataFrame:
    """Five steps, not rescaled."""
    ranks = G.pagerank(_vertices(t), _edges(t), 0.1, 5, normalize=False)
    return ranks.withColumn("pagerank", F.round("pagerank", 6))


@job(
    "pagerank_top",
    f"""WITH {GRAPH}, {_rank_sql(5)}, k AS (SELECT count(*) / sum(r) AS k FROM r5),
    i AS (SELECT dst AS id, count(*) AS in_degree FROM e GROUP BY 1), o AS (SELECT src AS id, count(*) AS out_degree FROM e GROUP BY 1)
    SELECT id, round(r * k, 6) AS pagerank, in_degree, out_degree FROM r5 JOIN i USING (id) JOIN o USING (id), k
    ORDER BY pagerank DESC, id LIMIT 20""",
)
def pagerank_top(t: Tables) -> DataFrame:
    """Rescaled ranks joined with both degrees, greatest first."""
    e = cut_lineage(_edges(t))
    ranks = G.pagerank(_vertices(t), e, 0.1, 5)
    both = ranks.join(G.degrees(e, "dst", "in_degree"), "id").join(G.degrees(e, "src", "out_degree"), "id")
    return both.withColumn("pagerank", F.round("pagerank", 6)).orderBy(F.desc("pagerank"), "id").limit(20)


@job(
    "motif_two_hop",
    f"""WITH {GRAPH} SELECT x.src AS a, x.dst AS b, y.dst AS c, count(*) AS cnt FROM e x JOIN e y ON x.dst = y.src
    JOIN v va ON va.id = x.src JOIN v vc ON vc.id = y.dst WHERE va.id LIKE 'C%' AND va.nation = 3 AND vc.id LIKE 'S%' AND vc.nation = 7
    GROUP BY ALL""",
)
def motif_two_hop(t: Tables) -> DataFrame:
    """Two-hop chains between customers of one nation and suppliers of another."""
    return G.two_hops(_vertices(t), _edges(t), "id LIKE 'C%' AND nation = 3", "id LIKE 'S%' AND nation = 7")


@job(
    "bfs_paths",
    f"""WITH {GRAPH}, d AS MATERIALIZED (SELECT DISTINCT src, dst FROM e),
    goal AS MATERIALIZED (SELECT id FROM v WHERE id LIKE 'S%' AND nation = 7 AND id <> 'S0'),
    hop1 AS MATERIALIZED (SELECT dst AS a FROM d WHERE src = 'S0'),
    hop2 AS MATERIALIZED (SELECT a, dst AS b FROM hop1 JOIN d ON src = a)
    SELECT 'S0>' || a || '>' || b || '>' || dst AS path, 3 AS length FROM hop2 JOIN d ON src = b WHERE dst IN (SELECT id FROM goal)""",
)
def bfs_paths(t: Tables) -> DataFrame:
    """All shortest paths from one supplier to the suppliers of a nation."""
    paths = G.shortest_paths(_vertices(t), _edges(t), "id = 'S0'", "id LIKE 'S%' AND nation = 7", 4)
    return paths.select(F.array_join("path", ">").alias("path"), "length")


@job(
    "direct_routes",
    f"""WITH {GRAPH} SELECT DISTINCT v.id, n_name FROM e JOIN v ON v.id = dst JOIN nation ON n_nationkey = v.nation WHERE src = 'S1'""",
)
def direct_routes(t: Tables) -> DataFrame:
    """Direct destinations of one source with their country."""
    e = _edges(t).where("kind = 'refunded'")
    ends = G.destinations(e, _vertices(t), "S1", ["nation"])
    names = t.nation.select(F.col("n_nationkey").alias("nation"), "n_name")
    return ends.join(names, "nation").select("id", "n_name")


@job(
    "destination_countries",
    f"""WITH {GRAPH} SELECT n_name, count(DISTINCT v.id) AS cnt FROM e JOIN v ON v.id = dst JOIN nation ON n_nationkey = v.nation
    WHERE src = 'S1' GROUP BY 1""",
)
def destination_countries(t: Tables) -> DataFrame:
    """Countries reached directly from one source (non-stop edges only)."""
    return direct_routes(t).groupBy("n_name").agg(F.count(F.lit(1)).alias("cnt"))


@job(
    "trip_nodes",
    "SELECT l_partkey AS id FROM lineitem UNION SELECT l_suppkey FROM lineitem",
)
def trip_nodes(t: Tables) -> DataFrame:
    """Distinct starts and ends as one node table."""
    return G.nodes_of(t.lineitem, "l_partkey", "l_suppkey")
