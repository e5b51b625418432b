"""Nearest neighbours by inverted lists: cells around sampled centres, short codes in the cells, exact distances for a short list.

The index is learned on a bounded sample: centres by k-means, and for each few components of a vector a book of 256 values. Every row
then gets its cell and its code, one byte for each book. A query looks into the cells of its nearest centres, adds up distances from
the codes by table, and only the best of these, some ``refine`` rows, are joined with their vectors and worked out exactly. The number of
cells looked into is the least that finds ``target`` of the neighbours within the sample, so clustered vectors need few and
vectors without any structure need most; the exact part is ``refine`` rows for each query in both cases.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, isqrt
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .sampling import take_sample
from .windows import top_per_group

#: Rows that centres and books are learned from, and rows of these that serve as queries when probes are chosen.
SAMPLE_ROWS, TRIAL_ROWS = 20_000, 300
MOST_CELLS = 1024
#: Components of a vector for one byte of its code.
COMPONENTS = 4
#: Rows of whole cells (or of a piece of a larger cell), and queries, that one task works on; rows of a batch sent to tasks.
CHUNK, ASKED, SENT = 50_000, 2_000, 20_000


def usable(vec: Column, width: int | None = None) -> Column:
    """True for a vector with finite components only (and of ``width``)."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ok = vec.isNotNull() & (F.size(vec) > 0) & fine
    return F.coalesce(ok if width is None else ok & (F.size(vec) == width), F.lit(False))


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T


def _means(rows: np.ndarray, count: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """Centres by k-means; a centre that loses all rows stays where it is."""
    centres = rows[rng.choice(len(rows), min(count, len(rows)), replace=False)].copy()
    for _ in range(rounds):
        own = _squares(rows, centres).argmin(1)
        size = np.bincount(own, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, own, rows)
        centres[size > 0] = total[size > 0] / size[size > 0, None]
    return centres


class Quantiser(NamedTuple):
    centres: np.ndarray
    spans: list[tuple[int, int]]  # components of each book
    books: list[np.ndarray]

    def cells(self, rows: np.ndarray) -> np.ndarray:
        return _squares(rows, self.centres).argmin(1)

    def codes(self, rows: np.ndarray) -> np.ndarray:
        out = [_squares(rows[:, a:b], book).argmin(1) for (a, b), book in zip(self.spans, self.books)]
        return np.stack(out, axis=1).astype(np.uint8)

    def tables(self, query: np.ndarray) -> list[np.ndarray]:
        """Squared distances of a query's components to each value of each book."""
        return [((book - query[a:b]) ** 2).sum(1) for (a, b), book in zip(self.spans, self.books)]


def _learn(rows: np.ndarray, cells: int, seed: int) -> Quantiser:
    rng = np.random.default_rng(seed)
    width = rows.shape[1]
    spans = [(a, min(a + COMPONENTS, width)) for a in range(0, width, COMPONENTS)]
    return Quantiser(_means(rows, cells, 10, rng), spans, [_means(rows[:, a:b], 256, 6, rng) for a, b in spans])


def _probes(model: Quantiser, rows: np.ndarray, k: int, target: float, seed: int) -> int:
    """The fewest cells that hold ``target`` of the k nearest, over trial rows of the sample."""
    chosen = np.random.default_rng(seed).permutation(len(rows))[:TRIAL_ROWS]
    own, distance = model.cells(rows), _squares(rows[chosen], rows)
    distance[np.arange(len(chosen)), chosen] = np.inf  # not itself
    near = np.argsort(distance, axis=1)[:, : min(k, len(rows) - 1)]
    place = np.argsort(np.argsort(_squares(rows[chosen], model.centres), axis=1), axis=1)
    needed = np.sort(np.take_along_axis(place, own[near], axis=1).ravel()) + 1
    return int(needed[min(len(needed) - 1, ceil(target * len(needed)) - 1)]) if len(needed) else 1


class VectorIndex(NamedTuple):
    model: Quantiser
    probes: int
    rows: int
    sizes: np.ndarray  # rows of each cell
    codes: DataFrame  # id, cell, piece, code
    vectors: DataFrame  # id, vec


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float)


def build(train: DataFrame, k: int = 10, target: float = 0.97, cells: int | None = None, sample: int = SAMPLE_ROWS, seed: int = 11) -> VectorIndex | None:
    """The index of ``train`` (id, vec: array<double>); None if no row has a usable vector.

    All vectors must be as long as most of them are told to be by the first of the sample; others, and null, empty or non-finite ones, take no part.
    ``cells`` is about the root of the row count if not given. ``sample`` rows at most come to the driver.
    """
    fine = train.select("id", "vec").where(usable(F.col("vec")))
    widths = fine.groupBy(F.size("vec").alias("w")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "w").first()
    if widths is None:
        return None
    fine = fine.where(F.size("vec") == widths.w)
    rows = _matrix(pd.Series([r.vec for r in take_sample(fine, "id", sample, seed).collect()]))
    count = min(cells or max(1, isqrt(widths.n)), MOST_CELLS, len(rows))
    model = _learn(rows, count, seed)
    probes = _probes(model, rows, k, target, seed) if len(rows) > 1 else 1

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                x = _matrix(b["vec"])
                yield pd.DataFrame({"id": b["id"], "cell": model.cells(x).astype("int32"), "code": [c.tobytes() for c in model.codes(x)]})

    kind = dict(train.dtypes)["id"]
    coded = cut_lineage(fine.mapInPandas(place, f"id {kind}, cell int, code binary"))
    sizes = np.zeros(len(model.centres), dtype=np.int64)
    for r in coded.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect():  # one row for each cell
        sizes[r.cell] = r.n
    pieces = F.get(F.array(*[F.lit(max(1, ceil(int(n) / CHUNK))) for n in sizes]), F.col("cell"))
    return VectorIndex(model, probes, widths.n, sizes, coded.withColumn("piece", F.pmod(F.xxhash64("id"), pieces).cast("int")), fine)


def _blocks(sizes: np.ndarray) -> np.ndarray:
    """The first block of each cell: neighbouring cells share a block of ``CHUNK`` rows at most, a larger cell has a block for each piece."""
    first, at, held = np.zeros(len(sizes), dtype=np.int64), 0, 0
    for cell, n in enumerate(sizes):
        if held and held + n > CHUNK:
            at, held = at + 1, 0
        first[cell], held = at, held + int(n)
        if n > CHUNK:
            at, held = at + ceil(int(n) / CHUNK), 0
    return first


def shortlist(index: VectorIndex, query: DataFrame, refine: int) -> DataFrame:
    """(query_id, id): for each row of ``query`` (query_id, vec) the ``refine`` rows of its cells that are nearest by their codes.

    Cells are gathered into blocks. A query is sent once to each block that holds some of its cells, with these cells, and gets
    at most ``refine`` rows from there, so what is sent and returned follows the number of blocks, not that of cells looked into.
    """
    model, probes = index.model, index.probes
    kind, key = dict(query.dtypes)["query_id"], dict(index.codes.dtypes)["id"]
    first = _blocks(index.sizes)
    last = first + np.maximum(1, np.ceil(index.sizes / CHUNK).astype(np.int64)) - 1
    step = max(1, SENT // (int(last.max()) + 1))

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for start in range(0, len(b), step):
                some = b.iloc[start : start + step]
                near = np.argsort(_squares(_matrix(some["vec"]), model.centres), axis=1, kind="stable")[:, :probes]
                at, block, cells = [], [], []
                for i, own in enumerate(np.sort(near, axis=1)):  # blocks rise with cells
                    own = np.repeat(own, last[own] - first[own] + 1)
                    place = first[own] + np.arange(len(own)) - np.searchsorted(own, own)
                    edges = np.flatnonzero(np.diff(place)) + 1
                    parts = np.split(own, edges)
                    at.extend([i] * len(parts))
                    block.extend(place[np.concatenate([[0], edges])])
                    cells.extend(parts)
                yield some.iloc[at].reset_index(drop=True).assign(block=np.array(block, dtype="int32"), cells=cells)

    parts = max(1, ceil(query.count() / ASKED))
    part = F.pmod(F.xxhash64("query_id"), F.lit(parts)).cast("int")
    asks = query.select("query_id", "vec").mapInPandas(visit, f"query_id {kind}, vec array<double>, block int, cells array<int>").withColumn("part", part)
    block = (F.get(F.array(*[F.lit(int(n)) for n in first]), F.col("cell")) + F.col("piece")).cast("int")
    have = index.codes.withColumn("block", block).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def best(asked: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        names, found, least = [], [], []
        if len(asked) and len(rows):
            rows = rows.sort_values("id", na_position="first", ignore_index=True).sort_values("cell", kind="stable")
            rank = rows.index.to_numpy()  # place by id
            code = np.frombuffer(b"".join(rows["code"]), dtype=np.uint8).reshape(len(rows), -1).T
            ids, cell = rows["id"].to_numpy(), rows["cell"].to_numpy()
            for name, vec, cells in zip(asked["query_id"], asked["vec"], asked["cells"]):
                low, high = np.searchsorted(cell, cells, "left"), np.searchsorted(cell, cells, "right")
                own = np.concatenate([np.arange(a, b) for a, b in zip(low, high)])
                if not len(own):
                    continue
                mine = code if len(own) == len(rows) else code[:, own]
                rough = sum(table[c] for table, c in zip(model.tables(np.asarray(vec, dtype=float)), mine))
                keep = min(refine, len(own))
                near = np.flatnonzero(rough <= np.partition(rough, keep - 1)[keep - 1])
                near = near[np.lexsort((rank[own[near]], rough[near]))[:keep]]  # ties by id
                names.append(np.full(keep, name, dtype=asked["query_id"].dtype))
                found.append(ids[own[near]])
                least.append(rough[near])
        flat = lambda x: np.concatenate(x) if x else []
        return pd.DataFrame({"query_id": flat(names), "id": flat(found), "rough": flat(least)})

    group = ["block", "part"]
    found = asks.groupBy(*group).cogroup(have.groupBy(*group)).applyInPandas(best, f"query_id {kind}, id {key}, rough double")
    return top_per_group(found, ["query_id"], [F.asc("rough"), F.asc("id")], refine).select("query_id", "id")


def search(index: VectorIndex, query: DataFrame, k: int, refine: int | None = None, digits: int = 9) -> DataFrame:
    """(query_id, id, distance, rn): about the ``k`` nearest rows of each row of ``query`` (id, vec), ties by id; distances are exact.

    ``refine`` rows (20 * k if not given) are worked out for each query. Queries whose vector is null, of another width or not finite
    get no rows; fewer than ``k`` come back where the cells of a query hold fewer.
    """
    width = index.model.centres.shape[1]
    asked = query.select(F.col("id").alias("query_id"), "vec").where(usable(F.col("vec"), width))
    short = shortlist(index, asked, refine or 20 * k)
    both = short.join(index.vectors, "id").join(asked.withColumnRenamed("vec", "wanted"), "query_id")
    square = F.aggregate(F.zip_with("vec", "wanted", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda a, x: a + x)
    exact = both.select("query_id", "id", F.round(F.sqrt(square), digits).alias("distance"))
    return top_per_group(exact, ["query_id"], [F.asc("distance"), F.asc("id")], k)


def report(index: VectorIndex, query: DataFrame, found: DataFrame, exact: DataFrame, k: int, refine: int | None = None) -> DataFrame:
    """One row: cells, probes, the shares of all pairs that were coded and that were worked out exactly, and the recall of ``found`` by
    ``exact``, the true neighbours (query_id, id) of some of the queries."""
    width = index.model.centres.shape[1]
    asked = query.where(usable(F.col("vec"), width)).agg(F.count(F.lit(1)).alias("queries"))
    hit = exact.select("query_id", "id").join(found.select("query_id", "id", F.lit(1).alias("hit")), ["query_id", "id"], "left")
    recall = hit.agg(F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))
    rows, probes = index.rows, min(index.probes, len(index.sizes))
    coded = float(np.sort(index.sizes)[::-1][:probes].sum()) / rows  # of the largest cells: no query looks at more
    return asked.crossJoin(recall).select(  # one row each
        "queries", F.lit(rows).cast("long").alias("rows"), F.lit(len(index.sizes)).alias("cells"), F.lit(probes).alias("probes"),
        F.lit(coded).alias("coded_share"), F.lit(min(1.0, (refine or 20 * k) / rows)).alias("exact_share"), "recall",
    )
