"""Graph jobs on a vertex table (``id``, ...) and an edge table (``src``, ``dst``, ...).

Edges whose endpoint is missing from the vertex table do not take part. Repeated edges are parallel
edges; where only their number matters they are counted before any shuffle of single edges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, fits


def triplets(v: DataFrame, e: DataFrame) -> DataFrame:
    """(src, edge, dst) structs of every edge with both endpoints known."""
    src = v.select(F.col("id").alias("_s"), F.struct(*v.columns).alias("src_v"))
    dst = v.select(F.col("id").alias("_d"), F.struct(*v.columns).alias("dst_v"))
    rows = e.select("src", "dst", F.struct(*e.columns).alias("edge"))
    rows = rows.join(src, F.col("src") == F.col("_s")).join(dst, F.col("dst") == F.col("_d"))
    return rows.select(F.col("src_v").alias("src"), "edge", F.col("dst_v").alias("dst"))


def _hashed(df: DataFrame) -> DataFrame:
    """``df``, some of the vertices, as the side of a join that is hashed, so that the edges on the other side are not sorted for it."""
    return F.broadcast(df) if fits(df) else df.hint("shuffle_hash")


def degrees(e: DataFrame, end: str, name: str) -> DataFrame:
    """Edges per vertex at ``end`` ('src' or 'dst'); vertices without such an edge are absent."""
    return e.groupBy(F.col(end).alias("id")).agg(F.count(F.lit(1)).alias(name))


def weighted(v: DataFrame, e: DataFrame) -> DataFrame:
    """Distinct known (src, dst) with the number ``w`` of parallel edges."""
    return _known_ends(v, _counted(e))


def _counted(e: DataFrame) -> DataFrame:
    return e.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("w"))


def _known_ends(v: DataFrame, w: DataFrame) -> DataFrame:
    ids = v.select("id").distinct()
    w = w.join(ids.select(F.col("id").alias("src")), "src", "left_semi")
    return w.join(ids.select(F.col("id").alias("dst")), "dst", "left_semi")


def pagerank(
    v: DataFrame, e: DataFrame, reset: float = 0.1, steps: int = 5, normalize: bool = True, cut_every: int = 3
) -> DataFrame:
    """(id, pagerank) after a fixed number of steps.

    Ranks start at 1; a step gives ``reset + (1 - reset) * sum(rank / outdegree)`` over incoming edges.
    ``normalize`` rescales the result to sum to the number of vertices, since sinks lose rank.
    """
    ids = cut_lineage(v.select("id").distinct())
    w = cut_lineage(_known_ends(ids, cut_lineage(_counted(e))))  # each write lets go of the shuffles before it
    out = w.groupBy("src").agg(F.sum("w").alias("o"))
    flow = cut_lineage(w.join(out, "src").select("src", "dst", (F.col("w") / F.col("o")).alias("p")))
    ranks = ids.withColumn("pagerank", F.lit(1.0))
    for step in range(1, steps + 1):
        gained = (
            flow.join(ranks.withColumnRenamed("id", "src"), "src")
            .groupBy(F.col("dst").alias("id"))
            .agg(F.sum(F.col("pagerank") * F.col("p")).alias("g"))
        )
        ranks = ids.join(gained, "id", "left").select(
            "id", (F.lit(reset) + (1 - reset) * F.coalesce("g", F.lit(0.0))).alias("pagerank")
        )
        if step % cut_every == 0 and step < steps:
            ranks = cut_lineage(ranks)
    if not normalize:
        return ranks
    ranks = cut_lineage(ranks)
    scale = ranks.agg((F.count(F.lit(1)) / F.sum("pagerank")).alias("k")).scalar()
    return ranks.select("id", (F.col("pagerank") * scale).alias("pagerank"))


def two_hops(v: DataFrame, e: DataFrame, a: Column | str, c: Column | str) -> DataFrame:
    """Chains (a) -> (b) -> (c) with predicates on both end vertices, and the number of edge pairs of each.

    The end predicates cut the edges first; parallel edges are counted first, so a chain is one row
    however many edges repeat it.
    """
    starts = _hashed(v.where(a).select(F.col("id").alias("src")))
    ends = _hashed(v.where(c).select(F.col("id").alias("dst")))
    ab = weighted(v, e.join(starts, "src", "left_semi")).select(F.col("src").alias("a"), F.col("dst").alias("b"), F.col("w").alias("w1"))
    bc = weighted(v, e.join(ends, "dst", "left_semi")).select(F.col("src").alias("b"), F.col("dst").alias("c"), F.col("w").alias("w2"))
    return ab.join(bc, "b").select("a", "b", "c", (F.col("w1") * F.col("w2")).alias("cnt"))


def shortest_paths(v: DataFrame, e: DataFrame, source: Column | str, target: Column | str, longest: int = 10) -> DataFrame:
    """All shortest paths from the vertices meeting ``source`` to those meeting ``target``.

    Columns ``path`` (vertex ids from start to target) and ``length`` (edges), for the least length with a hit;
    no rows without one. The search keeps one row per reached vertex and layer edge; paths are written out
    only from edges that lead to a target.
    """
    starts = cut_lineage(v.where(source).select("id").distinct())
    goals = cut_lineage(v.where(target).select("id").distinct())
    here = starts.join(goals, "id", "left_semi")
    if not fits(here, 0):
        return _as_path(here.select(F.col("id").alias("v0")), 0)
    edges = cut_lineage(weighted(v, e).select("src", "dst"))
    seen, frontier, layers = starts, starts, []
    for _ in range(longest):
        step = edges.join(frontier.withColumnRenamed("id", "src"), "src", "left_semi")
        step = cut_lineage(step.join(seen.withColumnRenamed("id", "dst"), "dst", "left_anti").select("src", "dst"))
        layers.append(step)
        frontier = cut_lineage(step.select(F.col("dst").alias("id")).distinct())
        hit = frontier.join(goals, "id", "left_semi")
        if not fits(hit, 0):
            return _paths(layers, goals)
        if fits(frontier, 0):
            break
        seen = cut_lineage(seen.unionByName(frontier))
    return _as_path(starts.where(F.lit(False)).select(F.col("id").alias("v0")), 0)


def _as_path(vertices: DataFrame, length: int) -> DataFrame:
    path = F.array(*[F.col(f"v{i}") for i in range(length + 1)])
    return vertices.select(path.alias("path"), F.lit(length).alias("length"))


def _paths(layers: list[DataFrame], goals: DataFrame) -> DataFrame:
    wanted, useful = goals, []
    for step in reversed(layers):
        kept = step.join(wanted.withColumnRenamed("id", "dst"), "dst", "left_semi").select("src", "dst")
        useful.append(kept)
        wanted = kept.select(F.col("src").alias("id")).distinct()
    useful.reverse()
    paths = useful[0].toDF("v0", "v1")
    for depth, step in enumerate(useful[1:], start=1):
        paths = paths.join(step.toDF(f"v{depth}", f"v{depth + 1}"), f"v{depth}")
    return _as_path(paths, len(useful))


def destinations(e: DataFrame, v: DataFrame, source: str, attributes: list[str]) -> DataFrame:
    """Distinct direct destinations of one vertex with their attributes."""
    ends = e.where(F.col("src") == source).select(F.col("dst").alias("id")).distinct()
    return ends.join(v.select("id", *attributes), "id")


def nodes_of(e: DataFrame, start: str, end: str) -> DataFrame:
    """Distinct starts and ends as one vertex table."""
    sides = [e.select(F.col(c).alias("id")).distinct() for c in (start, end)]
    return reduce(DataFrame.union, sides).distinct()


def components(ids: DataFrame, e: DataFrame, longest: int = 64) -> DataFrame:
    """(id, component): least id reachable over undirected edges.

    Alternating star contraction: every vertex links its larger neighbours, then its smaller ones, to the
    least vertex it sees, until only stars around the least ids are left. Rounds grow with the logarithm of
    the size whatever the shape. Minima combine before their shuffle and hot vertices meet their edges in
    a join, which splits.
    """
    links = e.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
    links, mark = cut_lineage(links.distinct()), None
    for _ in range(longest):
        both = links.union(links.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # The larger neighbours of u go to the least vertex around u.
        up = cut_lineage(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        root = up.groupBy("u").agg(F.min("v").alias("m"))
        down = up.join(root, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = cut_lineage(down.union(root.select("u", F.col("m").alias("v"))).distinct())
        seen = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            out = ids.select("id").distinct().join(links.select(F.col("u").alias("id"), F.col("v").alias("c")), "id", "left")
            return out.select("id", F.coalesce("c", "id").alias("component"))
        mark = seen
    raise RuntimeError(f"components did not settle in {longest} rounds")
