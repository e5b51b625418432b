"""Point-in-zone joins and extreme distances between points."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import haversine, on_sphere
from ..session import cut_lineage, small_side
from .relational import outer_join
from .windows import top_per_group

# --- zones ---------------------------------------------------------------------------------------


def _segments(ring: Column) -> Column:
    """(a, b) pairs of neighbouring ring points, the last joined to the first."""
    n = F.size(ring)
    return F.transform(ring, lambda p, i: F.struct(p.alias("a"), F.get(ring, (i + 1) % n).alias("b")))


def inside(rings: Column, x: Column, y: Column) -> Column:
    """Even-odd test against rings of (x, y) points; a point on a boundary is outside."""
    sides = F.flatten(F.transform(rings, _segments))

    def cross(s: Column) -> Column:
        a, b = s["a"], s["b"]
        at = (b["x"] - a["x"]) * (y - a["y"]) / F.nullif(b["y"] - a["y"], F.lit(0.0)) + a["x"]
        return ((a["y"] > y) != (b["y"] > y)) & (x < at)

    def on(s: Column) -> Column:
        a, b = s["a"], s["b"]
        turn = (b["x"] - a["x"]) * (y - a["y"]) - (b["y"] - a["y"]) * (x - a["x"])
        return (
            (turn == 0)
            & x.between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"]))
            & y.between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))
        )

    crossings = F.size(F.filter(sides, lambda s: F.coalesce(cross(s), F.lit(False))))
    return (crossings % 2 == 1) & ~F.exists(sides, on)


def zone_cells(zones: DataFrame, zone: str, cell: float) -> DataFrame:
    """Each zone once per grid cell its bounding box touches."""
    corners = F.flatten("rings")
    low = lambda axis: F.floor(F.array_min(F.transform(corners, lambda p: p[axis])) / cell)
    high = lambda axis: F.floor(F.array_max(F.transform(corners, lambda p: p[axis])) / cell)
    return (
        zones.select(zone, "rings", F.explode(F.sequence(low("x"), high("x"))).alias("_cx"), low("y").alias("_l"), high("y").alias("_h"))
        .withColumn("_cy", F.explode(F.sequence("_l", "_h")))
        .select(zone, "rings", "_cx", "_cy")
    )


def zone_matches(points: DataFrame, zones: DataFrame, zone: str, x: str, y: str, cell: float) -> DataFrame:
    """Every (point, zone) with the point inside: equi-join on the grid cell, then the exact test."""
    cells = small_side(zone_cells(zones, zone, cell))
    placed = points.withColumns({"_cx": F.floor(F.col(x) / cell), "_cy": F.floor(F.col(y) / cell)})
    hits = placed.join(cells, ["_cx", "_cy"]).where(inside(F.col("rings"), F.col(x), F.col(y)))
    return hits.drop("_cx", "_cy", "rings")


def zone_of(points: DataFrame, zones: DataFrame, key: str, zone: str, x: str, y: str, cell: float) -> DataFrame:
    """(key, zone) of every point: the least zone that contains it, NULL for none."""
    first = zone_matches(points, zones, zone, x, y, cell).groupBy(key).agg(F.min(zone).alias(zone))
    return points.select(key).join(first, key, "left")


def zone_totals(
    starts: DataFrame, ends: DataFrame, zones: DataFrame, key: str, zone: str, x: str, y: str, cell: float
) -> DataFrame:
    """Starts and ends summed per zone, busiest first. Both inputs hold ``key, x, y`` per trip end;
    trips are counted per station before the zone join. Counts are written, as the joins read them several times."""
    counted = [
        cut_lineage(side.groupBy(key, x, y).agg(F.count(F.lit(1)).alias(name))) for side, name in ((starts, "starts"), (ends, "ends"))
    ]
    stations = cut_lineage(outer_join(counted[0], counted[1], [key, x, y], "full").na.fill(0, ["starts", "ends"]))
    located = zone_of(stations, zones, key, zone, x, y, cell).join(stations, key)
    totals = located.groupBy(zone).agg(F.sum("starts").alias("starts"), F.sum("ends").alias("ends"))
    return totals.orderBy(F.desc(F.col("starts") + F.col("ends")), zone)


# --- distances -----------------------------------------------------------------------------------


def nearest_to(points: DataFrame, key: str, lon: str, lat: str, at: tuple[float, float], n: int) -> DataFrame:
    """The ``n`` points nearest to ``at`` = (lon, lat), in km."""
    d = haversine(F.lit(at[0]), F.lit(at[1]), F.col(lon), F.col(lat))
    return points.select(key, F.round(d, 6).alias("km")).orderBy("km", key).limit(n)


def extreme_pairs(
    points: DataFrame,
    key: str,
    lon: str,
    lat: str,
    n: int,
    farthest: bool = False,
    budget: int = 200_000,
    deepest: int = 40,
    digits: int = 6,
) -> DataFrame:
    """The ``n`` nearest (or farthest) pairs id1 < id2 among all points, by km then ids. Exact.

    Pairs of grid cells are refined together: a pair whose bounding boxes cannot beat the ``n``-th best
    bound found so far is dropped, so points are compared only inside the few surviving cell pairs.
    Points at one place are first reduced to the ``n + 1`` least ids, all that a best ``n`` can need.
    """
    x, y, z = on_sphere(F.col(lon), F.col(lat))
    place = points.select(F.col(key).alias("id"), F.col(lon).cast("double").alias("lon"), F.col(lat).cast("double").alias("lat"))
    kept = top_per_group(place, ["lon", "lat"], [F.asc("id")], n + 1).drop("rn")
    rows = cut_lineage(kept.withColumns({"x": x, "y": y, "z": z}))
    box = rows.agg(*[F.min(c).alias(f"{c}0") for c in "xyz"], *[F.max(c).alias(f"{c}1") for c in "xyz"]).first()
    if box["x0"] is None:
        return _rank_pairs(rows.limit(0), rows.limit(0), rows, n, farthest, digits)
    side = max(max(box[f"{c}1"] - box[f"{c}0"] for c in "xyz"), 1e-9) * (1 + 1e-9)

    def cells(level: int, above: int) -> DataFrame:
        """Boxes and counts of the non-empty cells of one level, with their cell at the level ``above``."""
        step = side / 2**level
        c = [F.floor((F.col(a) - F.lit(box[f"{a}0"])) / F.lit(step)).cast("long") for a in "xyz"]
        up = [F.shiftright(k, level - above) for k in c]
        return rows.groupBy(F.struct(*[k.alias(a) for k, a in zip(c, "xyz")]).alias("cell")).agg(
            F.first(F.struct(*[k.alias(a) for k, a in zip(up, "xyz")])).alias("parent"),
            F.count(F.lit(1)).alias("cnt"),
            *[F.min(a).alias(f"{a}0") for a in "xyz"],
            *[F.max(a).alias(f"{a}1") for a in "xyz"],
        )

    def paired(level: int, above: int, parents: DataFrame | None) -> DataFrame:
        """Cell pairs a <= b below the surviving parent pairs, with chord bounds and pair counts."""
        here = cut_lineage(cells(level, above))
        a = here.select(*[F.col(c).alias(f"a_{c}") for c in here.columns])
        b = here.select(*[F.col(c).alias(f"b_{c}") for c in here.columns])
        if parents is None:  # at most 512 cells, all below the one root
            both = a.join(b, F.col("a_parent") == F.col("b_parent"))
        else:
            both = parents.join(a, F.col("pa") == F.col("a_parent")).join(b, F.col("pb") == F.col("b_parent"))
        # Below one parent each pair comes twice; below two different parents, in one order only.
        both = both.where((F.col("a_parent") != F.col("b_parent")) | (F.col("a_cell") <= F.col("b_cell")))
        gaps, spans = [], []
        for c in "xyz":
            gap = F.greatest(F.col(f"a_{c}0") - F.col(f"b_{c}1"), F.col(f"b_{c}0") - F.col(f"a_{c}1"), F.lit(0.0))
            span = F.greatest(F.col(f"a_{c}1") - F.col(f"b_{c}0"), F.col(f"b_{c}1") - F.col(f"a_{c}0"))
            gaps.append(gap * gap)
            spans.append(span * span)
        same = F.col("a_cell") == F.col("b_cell")
        pairs = F.when(same, F.col("a_cnt") * (F.col("a_cnt") - 1) / 2).otherwise(F.col("a_cnt") * F.col("b_cnt"))
        return both.select(
            F.col("a_cell").alias("pa"),
            F.col("b_cell").alias("pb"),
            reduce(lambda p, q: p + q, gaps).alias("low"),
            reduce(lambda p, q: p + q, spans).alias("high"),
            pairs.alias("pairs"),
        ).where("pairs > 0")

    alive, above, level = None, 0, 3
    while True:
        found = cut_lineage(paired(level, above, alive))
        # The n-th best guaranteed distance: each of these n cell pairs holds at least one pair.
        sure = F.desc("low") if farthest else F.asc("high")
        best = found.orderBy(sure).limit(n).collect()
        if len(best) == n or sum(r["pairs"] for r in best) >= n:
            edge = best[-1]["low" if farthest else "high"]
            slack = 1e-9 * max(edge, 1e-6)
            keep = F.col("high") >= edge - slack if farthest else F.col("low") <= edge + slack
            found = found.where(keep)
        alive = found.select("pa", "pb", "pairs")
        total = alive.agg(F.sum("pairs").alias("p")).first()["p"] or 0
        alive = alive.select("pa", "pb")
        if total <= budget or level >= deepest:
            break
        above, level = level, level + 2
    step = side / 2**level
    c = [F.floor((F.col(a) - F.lit(box[f"{a}0"])) / F.lit(step)).cast("long").alias(a) for a in "xyz"]
    placed = rows.select(F.struct(*c).alias("cell"), "id", "lon", "lat")
    return _rank_pairs(alive, placed, placed, n, farthest, digits)


def _rank_pairs(alive: DataFrame, a: DataFrame, b: DataFrame, n: int, farthest: bool, digits: int) -> DataFrame:
    if "pa" not in alive.columns:
        return alive.sparkSession.createDataFrame([], "id1 long, id2 long, km double")
    left = a.select(F.col("cell").alias("pa"), *[F.col(c).alias(f"{c}_a") for c in ("id", "lon", "lat")])
    right = b.select(F.col("cell").alias("pb"), *[F.col(c).alias(f"{c}_b") for c in ("id", "lon", "lat")])
    both = alive.join(left, "pa").join(right, "pb")
    both = both.where((F.col("pa") != F.col("pb")) | (F.col("id_a") < F.col("id_b")))
    # Rounded with the lesser id first, so that the result does not depend on which cell came first.
    turn = F.col("id_a") > F.col("id_b")
    pick = lambda c, one, other: F.when(turn, F.col(f"{c}_{other}")).otherwise(F.col(f"{c}_{one}"))
    km = haversine(pick("lon", "a", "b"), pick("lat", "a", "b"), pick("lon", "b", "a"), pick("lat", "b", "a"))
    out = both.select(pick("id", "a", "b").alias("id1"), pick("id", "b", "a").alias("id2"), F.round(km, digits).alias("km"))
    return out.orderBy(F.desc("km") if farthest else F.asc("km"), "id1", "id2").limit(n)


def distance_stats(trips: DataFrame, km: str) -> DataFrame:
    """max, mean, sample stddev and median of a distance column."""
    from .ordered import exact_quantiles

    stats = trips.agg(F.max(km).alias("max_km"), F.avg(km).alias("mean_km"), F.stddev_samp(km).alias("std_km"))
    middle = exact_quantiles(trips, km, {"m": 0.5}).select("m").scalar()
    return stats.withColumn("median_km", middle)
