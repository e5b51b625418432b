"""Nearest neighbours by inner product over randomly rotated one-bit codes.

A vector is stored as the signs of its randomly rotated direction (packed bits), its norm, and the inner product of the direction
with its code. From these the inner product of the direction with a query is estimated without bias, with an error that
falls with the dimension and is bounded by ``bound`` standard deviations. What the signs leave of a direction may be coded by its own
signs and their mean size again, ``layers`` times in all: each layer takes one more bit for each component and cuts the error to
about 0.6 of what it was.

In each block of vectors a query first gets the exact inner products of the vectors with the best estimates. The ``k``-th of these is
a bound that every nearest vector reaches, so only vectors whose upper bound reaches it are worked out exactly as well.

Blocks of queries meet blocks of vectors; both sides are dealt out by block, so no task holds more than one block of
each, and a query gets back at most ``k`` rows from each block. Vectors are encoded once, before they are dealt out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Vectors and queries of one block.
BLOCK_ROWS = 16_384
QUERY_ROWS = 2_048
#: Standard deviations of the estimate that the bounds allow for.
BOUND = 4.0
#: One-bit codes of each vector, each of what those before it leave.
LAYERS = 4
#: Estimates, and pairs to work out exactly, that a task holds at a time.
CELLS, PAIRS = 4_000_000, 65_536


def rotation(width: int, seed: int = 7) -> np.ndarray:
    """A random orthogonal matrix, the same for every worker."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, width)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, turn: np.ndarray, layers: int = 1) -> tuple[np.ndarray, ...]:
    """(packed signs, norm, inner product of direction and code, mean sizes) of each row; signs of one layer after the other."""
    norm = np.sqrt((vectors * vectors).sum(axis=1))
    turned = (vectors / norm[:, None]) @ turn.T
    left, packed, sizes = turned.copy(), [], []
    for _ in range(layers):
        signs, size = left >= 0, np.abs(left).mean(axis=1)
        left -= np.where(signs, size[:, None], -size[:, None])
        packed.append(np.packbits(signs, axis=1))
        sizes.append(size)
    code = turned - left
    correction = (turned * code).sum(axis=1) / np.sqrt((code * code).sum(axis=1))
    return np.concatenate(packed, axis=1), norm, correction, np.stack(sizes, axis=1)


def _directions(packed: np.ndarray, sizes: np.ndarray, width: int) -> np.ndarray:
    """The codes as vectors of length 1."""
    out = np.zeros((len(packed), width), dtype=np.float32)
    for layer, bits in enumerate(np.split(packed, sizes.shape[1], axis=1)):
        signs = np.unpackbits(bits, axis=1, count=width).astype(np.float32) * 2 - 1
        out += signs * sizes[:, layer, None].astype(np.float32)
    return out / np.sqrt((out * out).sum(axis=1))[:, None]


def _errors(norm: np.ndarray, correction: np.ndarray, width: int, bound: float) -> np.ndarray:
    """Bounds of the errors of the estimates for queries of length 1."""
    spread = np.sqrt(np.maximum(1 - correction**2, 0)) / correction / np.sqrt(max(width - 1, 1))
    return bound * norm * spread + 1e-5 * norm  # and the rounding of single precision


def estimates(codes: tuple, query: np.ndarray, turn: np.ndarray, bound: float = BOUND) -> tuple[np.ndarray, np.ndarray]:
    """(estimate, error bound) of the inner products of ``query`` with the encoded rows."""
    packed, norm, correction, sizes = codes
    raw = _directions(packed, sizes, len(query)) @ (turn @ query).astype(np.float32)
    return raw * (norm / correction), np.sqrt(query @ query) * _errors(norm, correction, len(query), bound)


def exact(vectors: np.ndarray, queries: np.ndarray, at: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Inner products of the rows ``at`` of ``vectors`` with the rows ``of`` of ``queries`` in double precision, added up component by
    component."""
    out = np.empty(len(at))
    for start in range(0, len(at), PAIRS):
        some = slice(start, start + PAIRS)
        left, right = vectors[at[some]], queries[of[some]]
        total = np.zeros(len(left))
        for i in range(vectors.shape[1]):
            total += left[:, i] * right[:, i]
        out[some] = total
    return out


def block_best(query_ids, queries, ids, vectors, codes: tuple, k: int, bound: float, turn: np.ndarray) -> tuple[list, int]:
    """The ``k`` best of this block for each query as (query_id, vec_id, score) arrays, and how many pairs were worked out exactly."""
    packed, norm, correction, sizes = codes
    width = vectors.shape[1]
    towards = (_directions(packed, sizes, width) * (norm / correction)[:, None].astype(np.float32)).T
    error = _errors(norm, correction, width, bound).astype(np.float32)
    length = np.sqrt((queries * queries).sum(axis=1)).astype(np.float32)
    turned = (queries @ turn.T).astype(np.float32)
    order = np.argsort(ids)
    own = order[np.minimum(np.searchsorted(ids, query_ids, sorter=order), len(ids) - 1)]
    own = np.where(ids[own] == query_ids, own, -1)
    first = min(k + 1, len(ids))  # one of these may be the query itself
    out, taken = [], 0
    step = max(1, CELLS // len(ids))
    for start in range(0, len(query_ids), step):
        middle = turned[start : start + step] @ towards
        n = len(middle)
        lead = np.argpartition(-middle, first - 1, axis=1)[:, :first] if first < len(ids) else np.tile(np.arange(first), (n, 1))
        of = np.repeat(np.arange(start, start + n), first)
        score = np.where(lead.ravel() == own[of], -np.inf, exact(vectors, queries, lead.ravel(), of))
        reached = np.sort(score.reshape(n, first), axis=1)[:, max(0, first - k)]  # the k-th best of these
        high = middle + length[start : start + n, None] * error
        least = reached - 1e-5 * np.abs(reached)  # ``high`` is of single precision
        of, at = np.nonzero(high >= least[:, None])
        of += start
        taken += len(at) + n * first
        other = at != own[of]
        of, at = of[other], at[other]
        score = exact(vectors, queries, at, of)
        best = np.lexsort((ids[at], -score, of))
        of, at, score = of[best], at[best], score[best]
        place = np.arange(len(of)) - np.searchsorted(of, of)
        near = place < k
        out.append((query_ids[of[near]], ids[at[near]], score[near]))
    return out, taken


def usable(column: Column) -> Column:
    """Neither null, empty nor zero, and every component finite."""
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return column.isNotNull() & (F.size(column) > 0) & fine & F.exists(column, lambda x: x != 0)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, bound: float = BOUND) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows of ``vectors`` of largest inner product with each row of ``queries``.

    Both have vec_id and embedding; other columns are ignored. A query's own vec_id is no candidate; with fewer than ``k``
    candidates all are returned. Score is the exact inner product in double precision; ties go to the smaller vec_id. Vectors
    that are null, empty, zero or hold a null or non-finite component take no part, nor do rows without vec_id, nor vectors
    of another length than the commonest (of equals the longest). Rows that repeat a vec_id count once (the largest vector by
    components). Without queries or candidates there are no rows.
    """

    def clean(df: DataFrame) -> DataFrame:
        named = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
        named = named.where(F.col("vec_id").isNotNull() & usable(F.col("v")))
        return named.groupBy("vec_id").agg(F.max("v").alias("v"))

    base = cut_lineage(clean(vectors))
    asked = cut_lineage(clean(queries))
    lengths = base.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    width = common.d if common else 1
    blocks = max(1, -(-(common.n if common else 0) // BLOCK_ROWS))
    parts = max(1, -(-asked.count() // QUERY_ROWS))
    spread = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    group = ["block", "part"]
    tasks = 2 * blocks * parts  # the load is arithmetic, not bytes, so adaptive execution is to merge none
    coded = base.where(F.size("v") == width).mapInPandas(
        _coded(width), "vec_id long, v array<double>, bits binary, norm double, correction double, sizes array<double>"
    )
    have = coded.withColumns({"block": spread(blocks), "part": every(parts)}).repartition(tasks, *group)
    ask = asked.where(F.size("v") == width).withColumns({"part": spread(parts), "block": every(blocks)}).repartition(tasks, *group)

    def best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            empty = {"query_id": "int64", "vec_id": "int64", "score": "float64"}
            return pd.DataFrame({c: pd.Series(dtype=t) for c, t in empty.items()})
        bits = np.frombuffer(b"".join(right["bits"]), dtype=np.uint8).reshape(len(right), -1)
        codes = bits, right["norm"].to_numpy(), right["correction"].to_numpy(), np.stack(right["sizes"].to_list())
        found, _ = block_best(
            left["vec_id"].to_numpy(), np.stack(left["v"].to_list()), right["vec_id"].to_numpy(), np.stack(right["v"].to_list()),
            codes, k, bound, rotation(width),
        )
        return pd.DataFrame(dict(zip(["query_id", "vec_id", "score"], map(np.concatenate, zip(*found)))))

    met = ask.groupBy(*group).cogroup(have.groupBy(*group))
    found = met.applyInPandas(best, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _coded(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn = rotation(width)
        for batch in batches:
            if not len(batch):
                continue
            packed, norm, correction, sizes = encode(np.stack(batch["v"].to_list()), turn, LAYERS)
            bits = [row.tobytes() for row in packed]
            yield batch.assign(bits=bits, norm=norm, correction=correction, sizes=list(sizes))

    return run


def exact_pairs(vectors: Iterator[tuple[int, list]], queries: Iterator[tuple[int, list]], k: int) -> list[tuple]:
    """Brute force over small lists, to measure recall against."""
    base = list(vectors)
    out = []
    for q, v in queries:
        scored = []
        for i, w in base:
            if i != q:
                total = 0.0
                for a, b in zip(w, v):
                    total += a * b
                scored.append((-total, i))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k])]
    return out
