"""Repeatable pseudo-random numbers from row keys: the same row draws the same number on every run
and under every partitioning, and the digest is standard, so results can be recomputed elsewhere."""

from __future__ import annotations

from math import exp

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(seed: int, *keys: str | Column) -> Column:
    """Hex digest of ``seed-key1-key2...``."""
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws("-", F.lit(str(seed)), *[c.cast("string") for c in cols]).cast("binary"))


def word(hexed: Column, i: int) -> Column:
    """The ``i``-th 32-bit number (0..3) of a digest."""
    return F.conv(F.substring(hexed, 8 * i + 1, 8), 16, 10).cast("long")


def uniform(seed: int, *keys: str | Column) -> Column:
    """Uniform double in [0, 1) per row."""
    return word(digest(seed, *keys), 0) / F.lit(4294967296.0)


def bucket(n: int, seed: int, *keys: str | Column) -> Column:
    """Integer bucket 0..n-1 per row."""
    return word(digest(seed, *keys), 0) % n


def poisson_edges(rate: float) -> list[float]:
    """The values of Poisson(``rate``)'s distribution function, up to where 32 bits tell draws apart."""
    if not 0 < rate <= 500:
        raise ValueError("the rate must be above 0 and at most 500")
    total, term, k, out = 0.0, exp(-rate), 0, []
    while total < 1 - 2.0**-32 and k < 20 + 4 * rate:
        total += term
        out.append(total)
        k += 1
        term *= rate / k
    return out


def poisson(u: Column, rate: float = 1.0) -> Column:
    """Poisson(``rate``) draw from a uniform number by the inverse distribution function."""
    out = F.lit(0)
    for edge in poisson_edges(rate):
        out = out + F.when(u >= edge, 1).otherwise(0)
    return out


def poisson_one(u: Column) -> Column:
    """Poisson(1) draw from a uniform number."""
    return poisson(u)
