"""Exact nearest neighbours and density clustering without comparing all pairs."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .graph import components
from .sampling import take_sample
from .windows import top_per_group

# --- k nearest neighbours ----------------------------------------------------------------------------

#: Rows of a batch sent to the cells; distances that a task holds at a time.
SENT, HELD = 20_000, 1 << 20


def _to_matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0.0)


def nearest(
    train: DataFrame, query: DataFrame, k: int, cells: int = 64, chunk: int = 20_000, digits: int = 9
) -> DataFrame:
    """(query_id, id, distance, rn): the ``k`` nearest training rows of each query row, ties by id. Exact.

    Both tables hold ``id`` and ``vec`` (array<double>). Training rows are assigned to the nearest of a few
    sampled centres. A query first searches its own cell, which bounds its k-th distance; it then visits
    only the cells whose ball can hold something nearer. Cells are cut into chunks of bounded size on
    both sides, so a crowded cell is many tasks, and each task emits only its best ``k`` per query.
    """

    # At most `cells` vectors: the bound behind shipping the centres with the tasks.
    centres = _to_matrix(pd.Series([r["vec"] for r in take_sample(train, "id", cells, 11).collect()]))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                d = np.sqrt(_squares(_to_matrix(b["vec"]), centres))
                b["cell"] = d.argmin(1).astype("int32")
                b["reach"] = d.min(1)
                yield b

    placed = cut_lineage(
        train.select("id", "vec").mapInPandas(assign, train.select("id", "vec").schema.add("cell", "integer").add("reach", "double"))
    )
    stats = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("reach").alias("r")).collect()
    size = np.zeros(len(centres), dtype="int64")
    radius = np.zeros(len(centres))
    for s in stats:
        size[s["cell"]], radius[s["cell"]] = s["n"], s["r"]
    pieces = {c: max(1, ceil(n / chunk)) for c, n in enumerate(size)}
    pieces_col = F.get(F.array(*[F.lit(pieces[c]) for c in range(len(centres))]), F.col("cell"))
    placed = placed.select("id", "vec", "cell", F.pmod(F.xxhash64("id"), pieces_col).cast("int").alias("piece"))

    def visits(first: bool):
        def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            # A query may visit all cells, with its vector each time.
            step = max(1, SENT // len(centres))
            for b in (whole.iloc[i : i + step] for whole in batches for i in range(0, len(whole), step)):
                d = np.sqrt(_squares(_to_matrix(b["vec"]), centres))
                # k rows lie within (distance to centre + radius) of the cells nearest by that sum.
                reach = np.where(size > 0, d + radius, np.inf)
                order = reach.argsort(1)
                enough = (size[order].cumsum(1) >= k).argmax(1)
                short = size.sum() < k
                bound = np.inf if short else np.take_along_axis(reach, order, 1)[np.arange(len(b)), enough]
                bound = np.broadcast_to(bound, len(b)).copy()
                if first:
                    home = np.where(size > 0, d, np.inf).argmin(1)
                    chosen = np.zeros_like(d, dtype=bool)
                    chosen[np.arange(len(b)), home] = True
                else:
                    bound = np.fmin(bound, b["bound"].to_numpy(dtype=float))
                    chosen = (size > 0) & (d - radius <= bound[:, None] * (1 + 1e-9) + 1e-9)
                rows, cols = np.nonzero(chosen)
                out = b[["query_id", "vec"]].iloc[rows].reset_index(drop=True)
                out["cell"] = cols.astype("int32")
                out["bound"] = bound[rows]
                yield out

        return plan

    kind, key = dict(query.dtypes)["id"], dict(train.dtypes)["id"]
    asked = query.select(F.col("id").alias("query_id"), "vec")
    shape = f"query_id {kind}, vec array<double>, cell int, bound double"

    def search(visiting: DataFrame, limit_pieces: bool) -> DataFrame:
        load = {r["cell"]: r["n"] for r in visiting.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
        parts = {c: max(1, ceil(load.get(c, 0) / chunk)) for c in range(len(centres))}
        parts_col = F.get(F.array(*[F.lit(parts[c]) for c in range(len(centres))]), F.col("cell"))
        ask = visiting.withColumn("part", F.pmod(F.xxhash64("query_id"), parts_col).cast("int"))
        many = F.lit(1) if limit_pieces else pieces_col
        ask = ask.withColumn("piece", F.explode(F.sequence(F.lit(0), many - 1)))
        have = placed.where("piece = 0") if limit_pieces else placed
        have = have.withColumn("part", F.explode(F.sequence(F.lit(0), parts_col - 1)))

        def best(asks: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
            out = {"query_id": [], "id": [], "distance": []}
            if len(asks) and len(rows):
                x = _to_matrix(rows["vec"])
                ids = rows["id"].to_numpy()
                step = max(1, HELD // len(rows))
                for start in range(0, len(asks), step):
                    block = asks.iloc[start : start + step]
                    q = _to_matrix(block["vec"])
                    rough = _squares(q, x)
                    kk = min(k, len(rows))
                    edge = np.partition(rough, kk - 1, axis=1)[:, kk - 1]
                    slack = 1e-9 * (1 + (q * q).sum(1) + (x * x).sum(1).max())
                    for i, name in enumerate(block["query_id"]):
                        near = np.nonzero(rough[i] <= edge[i] + slack[i])[0]
                        d = np.round(np.sqrt(((x[near] - q[i]) ** 2).sum(1)), digits)
                        pick = np.lexsort((ids[near], d))[:kk]
                        out["query_id"].extend([name] * len(pick))
                        out["id"].extend(ids[near][pick])
                        out["distance"].extend(d[pick])
            return pd.DataFrame(out)

        group = ["cell", "piece", "part"]
        return (
            ask.groupBy(*group)
            .cogroup(have.groupBy(*group))
            .applyInPandas(best, f"query_id {kind}, id {key}, distance double")
        )

    start = asked.mapInPandas(visits(True), shape)
    home = search(start, True)
    kth = top_per_group(home, ["query_id"], [F.asc("distance"), F.asc("id")], k)
    bounds = kth.where(F.col("rn") == k).select("query_id", F.col("distance").alias("bound"))
    known = cut_lineage(asked.join(bounds, "query_id", "left"))
    found = search(cut_lineage(known.mapInPandas(visits(False), shape)), False)
    return top_per_group(found, ["query_id"], [F.asc("distance"), F.asc("id")], k)


def vote(neighbours: DataFrame, labels: DataFrame) -> DataFrame:
    """(query_id, label): most frequent label among the neighbours, least label on a tie."""
    counts = (
        neighbours.join(labels.select("id", "label"), "id").groupBy("query_id", "label").agg(F.count(F.lit(1)).alias("votes"))
    )
    return top_per_group(counts, ["query_id"], [F.desc("votes"), F.asc("label")], 1).select("query_id", "label")


# --- density clustering --------------------------------------------------------------------------------


def density_clusters(
    points: DataFrame, eps: float, min_points: int, budget: int = 200_000, deepest: int = 24
) -> DataFrame:
    """(id, cluster) of 2-D points ``id, x, y``: the least core id of the cluster, or -1 for noise.

    A core point has at least ``min_points`` points within ``eps`` (itself included). A border point
    within reach of several clusters takes the least.

    Grid cells have diagonal ``eps``, so all points of a cell with ``min_points`` members are core and
    belong together without a comparison. Only points of sparser cells (fewer than ``min_points``
    each) are compared with the 20 cells around, and two crowded cells are linked by refining their
    bounding boxes until a close pair is certain or excluded.
    """
    side = eps / sqrt(2) * (1 - 1e-12)
    cell = F.struct(F.floor(F.col("x") / side).alias("cx"), F.floor(F.col("y") / side).alias("cy"))
    rows = cut_lineage(points.select("id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).withColumn("cell", cell))
    counts = cut_lineage(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n")))
    offsets = [(i, j) for i in range(-2, 3) for j in range(-2, 3) if (i or j) and abs(i) + abs(j) < 4]
    around = F.explode(F.array(*[F.struct((F.col("cell.cx") + i).alias("cx"), (F.col("cell.cy") + j).alias("cy")) for i, j in offsets]))
    reach = eps * eps

    def close(a: str, b: str):
        dx, dy = F.col(f"{a}x") - F.col(f"{b}x"), F.col(f"{a}y") - F.col(f"{b}y")
        return dx * dx + dy * dy <= reach

    dense = counts.where(F.col("n") >= min_points).select("cell")
    thin = rows.join(counts.where(F.col("n") < min_points), "cell")
    probes = thin.select(F.col("id").alias("pid"), F.col("x").alias("px"), F.col("y").alias("py"), around.alias("cell"))
    met = probes.join(rows.select("cell", F.col("x").alias("qx"), F.col("y").alias("qy")), "cell").where(close("p", "q"))
    extra = met.groupBy(F.col("pid").alias("id")).agg(F.count(F.lit(1)).alias("m"))
    thin_core = (
        thin.join(extra, "id", "left").where(F.col("n") + F.coalesce("m", F.lit(0)) >= min_points).select("id", "x", "y", "cell")
    )
    core = cut_lineage(rows.join(dense, "cell", "left_semi").select("id", "x", "y", "cell").unionByName(thin_core))

    # Links between core cells with a sparse side: few points there, compared with the other cell's core.
    few = thin_core.select(F.col("cell").alias("src"), F.col("x").alias("px"), F.col("y").alias("py"), around.alias("cell"))
    thin_links = (
        few.join(core.select("cell", F.col("x").alias("qx"), F.col("y").alias("qy")), "cell")
        .where(close("p", "q"))
        .select("src", F.col("cell").alias("dst"))
        .distinct()
    )
    # Links between two crowded cells.
    pairs = dense.select(F.col("cell").alias("src"), around.alias("dst")).where("src < dst")
    pairs = pairs.join(dense.withColumnRenamed("cell", "dst"), "dst", "left_semi")
    links = thin_links.unionByName(_crowded_links(core, pairs, side, reach, budget, deepest))

    named = core.groupBy("cell").agg(F.min("id").alias("first"))
    ends = links.join(named.select(F.col("cell").alias("src"), F.col("first").alias("a")), "src").join(
        named.select(F.col("cell").alias("dst"), F.col("first").alias("b")), "dst"
    )
    joined = components(named.select(F.col("first").alias("id")), ends.select(F.col("a").alias("src"), F.col("b").alias("dst")))
    labels = cut_lineage(
        named.join(joined.select(F.col("id").alias("first"), F.col("component").alias("cluster")), "first").select("cell", "cluster")
    )
    # Least core id of a component: cells are named by their least core id and components by the least name.
    core_out = core.join(labels, "cell").select("id", "cluster")
    edge = thin.join(core.select("id"), "id", "left_anti")
    touch = edge.select(F.col("id").alias("pid"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("cell").alias("own"), around.alias("cell"))
    touch = touch.select("pid", "px", "py", "cell").unionByName(
        edge.select(F.col("id").alias("pid"), F.col("x").alias("px"), F.col("y").alias("py"), "cell")
    )
    near = (
        touch.join(core.select("cell", F.col("x").alias("qx"), F.col("y").alias("qy")), "cell")
        .where(close("p", "q"))
        .select("pid", "cell")
        .distinct()
        .join(labels, "cell")
        .groupBy(F.col("pid").alias("id"))
        .agg(F.min("cluster").alias("cluster"))
    )
    rest = edge.select("id").join(near, "id", "left").select("id", F.coalesce("cluster", F.lit(-1).cast("long")).alias("cluster"))
    return core_out.select("id", F.col("cluster").cast("long").alias("cluster")).unionByName(rest)


def _crowded_links(core: DataFrame, pairs: DataFrame, side: float, reach: float, budget: int, deepest: int) -> DataFrame:
    """Which of the crowded cell ``pairs`` (src, dst) hold two core points within reach."""
    places = core.select("cell", "x", "y").distinct()
    found = []
    alive = cut_lineage(pairs.select("src", "dst", F.lit(0).cast("long").alias("sx"), F.lit(0).cast("long").alias("sy"), F.lit(0).cast("long").alias("tx"), F.lit(0).cast("long").alias("ty")))
    level = 0
    while True:
        step = side / 2**level
        sub = places.withColumns({"ux": F.floor(F.col("x") / step), "uy": F.floor(F.col("y") / step)})
        boxes = sub.groupBy("cell", "ux", "uy").agg(
            F.count(F.lit(1)).alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")
        )
        a = boxes.select(F.col("cell").alias("src"), *[F.col(c).alias(f"a_{c}") for c in boxes.columns if c != "cell"])
        b = boxes.select(F.col("cell").alias("dst"), *[F.col(c).alias(f"b_{c}") for c in boxes.columns if c != "cell"])
        if level == 0:
            both = alive.select("src", "dst").join(a, "src").join(b, "dst")
        else:
            up = lambda c: F.floor(F.col(c) / 2)
            a = a.withColumns({"sx": up("a_ux"), "sy": up("a_uy")})
            b = b.withColumns({"tx": up("b_ux"), "ty": up("b_uy")})
            both = alive.join(a, ["src", "sx", "sy"]).join(b, ["dst", "tx", "ty"])
        gaps, spans = [], []
        for c in "xy":
            gap = F.greatest(F.col(f"a_{c}0") - F.col(f"b_{c}1"), F.col(f"b_{c}0") - F.col(f"a_{c}1"), F.lit(0.0))
            span = F.greatest(F.col(f"a_{c}1") - F.col(f"b_{c}0"), F.col(f"b_{c}1") - F.col(f"a_{c}0"))
            gaps.append(gap * gap)
            spans.append(span * span)
        both = cut_lineage(
            both.select(
                "src", "dst", F.col("a_ux").alias("sx"), F.col("a_uy").alias("sy"), F.col("b_ux").alias("tx"), F.col("b_uy").alias("ty"),
                (F.col("a_n") * F.col("b_n")).alias("work"),
                reduce(lambda p, q: p + q, gaps).alias("low"), reduce(lambda p, q: p + q, spans).alias("high"),
            ).where(F.col("low") <= reach)
        )
        sure = both.where(F.col("high") <= reach).select("src", "dst").distinct()
        found.append(sure)
        alive = both.join(sure, ["src", "dst"], "left_anti")
        work = alive.agg(F.sum("work").alias("w")).first()["w"] or 0
        if work <= budget or level >= deepest:
            break
        level += 1
    step = side / 2**level
    sub = places.withColumns({"ux": F.floor(F.col("x") / step), "uy": F.floor(F.col("y") / step)})
    p = sub.select(F.col("cell").alias("src"), F.col("ux").alias("sx"), F.col("uy").alias("sy"), F.col("x").alias("px"), F.col("y").alias("py"))
    q = sub.select(F.col("cell").alias("dst"), F.col("ux").alias("tx"), F.col("uy").alias("ty"), F.col("x").alias("qx"), F.col("y").alias("qy"))
    dx, dy = F.col("px") - F.col("qx"), F.col("py") - F.col("qy")
    last = alive.join(p, ["src", "sx", "sy"]).join(q, ["dst", "tx", "ty"]).where(dx * dx + dy * dy <= reach)
    found.append(last.select("src", "dst").distinct())
    return reduce(DataFrame.unionByName, found)
