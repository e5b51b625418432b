"""Order-dependent operators that stay balanced when one key holds most of the rows.

A plain ``Window.partitionBy(key)`` puts a whole key into one task. Here rows are range-partitioned by
(key, order) first, so a hot key is cut into many contiguous slices; each slice is handled alone and
gets a *carry* from the slices before it. A slice has at most one key that began in an earlier slice
(its first), so there are fewer carries than slices: that is the proven bound behind the broadcast.
``order`` must end in a tie-break for equal values to be spread over slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, shuffle_width

SLICE = "_slice"


def slice_by_order(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], slices: int | None = None
) -> DataFrame:
    """Range-partition by (keys, order) and record the slice number.

    The result is checkpointed because range bounds are sampled: a re-run of a lost task must see
    the same slice numbers as the carries were computed from.
    """
    n = slices or shuffle_width(df.sparkSession)
    placed = df.repartitionByRange(n, *keys, *order).withColumn(SLICE, F.spark_partition_id())
    return cut_lineage(placed)


def _with_carry(sliced: DataFrame, keys: Sequence[str], carry: DataFrame, names: Sequence[str]) -> DataFrame:
    """Attach the carries; NULL where a key begins in this very slice."""
    renamed = carry.select(
        F.col(SLICE).alias("_carry_slice"), *[F.col(k).alias(f"_ck_{k}") for k in keys], *names
    )
    cond = F.col(SLICE) == F.col("_carry_slice")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_ck_{k}"))
    return sliced.join(F.broadcast(renamed), cond, "left").drop("_carry_slice", *[f"_ck_{k}" for k in keys])


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    totals: dict[str, Column],
    products: dict[str, Column] | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Inclusive running sums (``totals``) and products of row expressions per key in the given order."""
    products = products or {}
    sliced = slice_by_order(df, keys, order, slices)
    per_slice = sliced.groupBy(*keys, SLICE).agg(
        *[F.sum(e).alias(f"_c_{n}") for n, e in totals.items()],
        *[F.product(e).alias(f"_c_{n}") for n, e in products.items()],
    )
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_slice.select(
        *keys,
        SLICE,
        F.count(F.lit(1)).over(before).alias("_prior"),
        *[F.sum(f"_c_{n}").over(before).alias(f"_c_{n}") for n in totals],
        *[F.product(F.col(f"_c_{n}")).over(before).alias(f"_c_{n}") for n in products],
    ).where("_prior > 0")
    carry_names = [f"_c_{n}" for n in [*totals, *products]]
    inside = (
        Window.partitionBy(*keys, SLICE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    local = sliced.select(
        "*",
        *[F.sum(e).over(inside).alias(n) for n, e in totals.items()],
        *[F.product(e).over(inside).alias(n) for n, e in products.items()],
    )
    out = _with_carry(local, keys, carry, carry_names)
    fixed = {n: F.coalesce(F.col(n) + F.col(f"_c_{n}"), F.col(n), F.col(f"_c_{n}")) for n in totals}
    fixed |= {n: F.coalesce(F.col(n) * F.col(f"_c_{n}"), F.col(n), F.col(f"_c_{n}")) for n in products}
    return out.withColumns(fixed).drop(SLICE, *carry_names)


def row_numbers(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str = "rn", slices: int | None = None
) -> DataFrame:
    """1-based position of each row within its key (or in the whole table for no keys)."""
    return running_totals(df, keys, order, {name: F.lit(1).cast("long")}, slices=slices)


def _last_known(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    include_current: bool,
    slices: int | None,
) -> DataFrame:
    sliced = slice_by_order(df, keys, order, slices)
    at = F.struct(*[F.col(o) for o in order])
    seen = sliced if not include_current else sliced.where(F.col(value).isNotNull())
    per_slice = seen.groupBy(*keys, SLICE).agg(F.max_by(F.col(value), at).alias("_last"))
    if include_current:
        # Slices holding only NULLs still need the value carried through them.
        every = sliced.select(*keys, SLICE).distinct()
        cond = [every[k].eqNullSafe(per_slice[k]) for k in [*keys, SLICE]]
        total = cond[0]
        for c in cond[1:]:
            total = total & c
        per_slice = every.join(per_slice, total, "left").select(*[every[k] for k in [*keys, SLICE]], "_last")
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_slice.select(
        *keys,
        SLICE,
        F.count(F.lit(1)).over(before).alias("_prior"),
        F.last("_last", ignorenulls=include_current).over(before).alias("_carry"),
    ).where("_prior > 0")
    inside = Window.partitionBy(*keys, SLICE).orderBy(*order)
    if include_current:
        local = F.last(value, ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
        out = _with_carry(sliced.withColumn(name, local), keys, carry, ["_carry"])
        return out.withColumn(name, F.coalesce(name, "_carry")).drop(SLICE, "_carry")
    out = _with_carry(
        sliced.withColumns({name: F.lag(value).over(inside), "_pos": F.row_number().over(inside)}),
        keys,
        carry,
        ["_carry"],
    )
    picked = F.when(F.col("_pos") == 1, F.col("_carry")).otherwise(F.col(name))
    return out.withColumn(name, picked).drop(SLICE, "_carry", "_pos")


def forward_fill(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, slices: int | None = None
) -> DataFrame:
    """Latest non-NULL ``value`` up to and including the row (ascending ``order``)."""
    return _last_known(df, keys, order, value, name, True, slices)


def previous_value(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str, slices: int | None = None
) -> DataFrame:
    """``value`` of the row before (ascending ``order``); NULL for the first row of a key."""
    return _last_known(df, keys, order, value, name, False, slices)


def exact_quantiles(
    df: DataFrame, value: str, probs: dict[str, float], by: Sequence[str] = (), interpolate: bool = True
) -> DataFrame:
    """Exact quantiles, one column per entry of ``probs``, one row per ``by`` group.

    Works on counts per distinct value, never on one buffer per group. ``interpolate`` gives the linear
    percentile; otherwise the lower element at ``ceil(p * n)``, which always occurs in the data.
    NULLs are skipped; a group of only NULLs is absent.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("_n"))
    run = running_totals(counts, by, [value], {"_cum": F.col("_n")})
    totals = counts.groupBy(*by).agg(F.sum("_n").alias("_total"))
    if by:
        run = run.join(totals, list(by))
    else:
        run = run.withColumn("_total", totals.select("_total").scalar())

    def at(pos: Column) -> Column:
        hit = (F.col("_cum") - F.col("_n") <= pos) & (pos < F.col("_cum"))
        return F.max(F.when(hit, F.col(value).cast("double")))

    aggs: list[Column] = [F.max("_total").alias("_total")]
    outs: list[Column] = []
    for name, p in probs.items():
        if interpolate:
            pos = (F.col("_total") - 1) * F.lit(float(p))
            aggs += [at(F.floor(pos)).alias(f"_lo_{name}"), at(F.ceil(pos)).alias(f"_hi_{name}")]
            frac = (F.col("_total") - 1) * F.lit(float(p))
            lo, hi = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
            outs.append((lo + (hi - lo) * (frac - F.floor(frac))).alias(name))
        else:
            pos = F.greatest(F.ceil(F.col("_total") * F.lit(float(p))) - 1, F.lit(0))
            aggs.append(at(pos).alias(f"_lo_{name}"))
            outs.append(F.col(f"_lo_{name}").alias(name))
    return run.groupBy(*by).agg(*aggs).select(*by, *outs)


def mid_ranks(df: DataFrame, value: str, weights: dict[str, Column]) -> DataFrame:
    """One row per distinct ``value``: its tie-averaged rank over the whole table and summed ``weights``."""
    counts = df.groupBy(value).agg(
        F.count(F.lit(1)).alias("ties"), *[F.sum(e).alias(n) for n, e in weights.items()]
    )
    run = running_totals(counts, [], [value], {"_cum": F.col("ties")})
    return run.withColumn("mid_rank", F.col("_cum") - F.col("ties") + (F.col("ties") + 1) / 2).drop("_cum")


def rolling_ranges(
    df: DataFrame,
    key: str,
    ts: str,
    row_id: str,
    value: str,
    widths: dict[str, int],
    scale: int = 6,
    slices: int | None = None,
) -> DataFrame:
    """Count and sum of ``value`` in the closed range [t - width, t] per key, for several widths (seconds).

    Computed as a difference of two running totals looked up by probe rows, so the cost is
    O(rows x widths) whatever the window width, and a hot key is split like any other. Sums accumulate
    as DECIMAL so that differences of large totals stay exact. Peers at the same instant count.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    probes = [F.struct(F.lit("").alias("w"), F.lit(1).alias("kind"), F.lit(0).cast("long").alias("shift"))]
    probes.append(F.struct(F.lit("_hi").alias("w"), F.lit(2).alias("kind"), F.lit(0).cast("long").alias("shift")))
    for name, seconds in widths.items():
        probes.append(
            F.struct(
                F.lit(name).alias("w"), F.lit(0).alias("kind"), F.lit(seconds * 1_000_000).cast("long").alias("shift")
            )
        )
    marks = (
        df.select(key, F.col(row_id).alias("_id"), micros.alias("_t"), F.col(value).alias("_v"))
        .withColumn("_p", F.explode(F.array(*probes)))
        .select(
            key,
            "_id",
            (F.col("_t") - F.col("_p.shift")).alias("_at"),
            F.col("_p.kind").alias("_kind"),
            F.col("_p.w").alias("_w"),
            F.when(F.col("_p.kind") == 1, F.col("_v")).cast(f"decimal(28,{scale})").alias("_v"),
        )
    )
    is_row = F.when(F.col("_kind") == 1, 1).otherwise(0).cast("long")
    run = running_totals(
        marks,
        [key],
        ["_at", "_kind", "_id"],
        {"_cn": is_row, "_cs": F.coalesce(F.col("_v"), F.lit(0).cast(f"decimal(28,{scale})"))},
        slices=slices,
    ).where("_kind <> 1")
    pick = lambda c, w: F.max(F.when(F.col("_w") == w, F.col(c)))
    out = []
    for name in widths:
        out.append((pick("_cn", "_hi") - pick("_cn", name)).alias(f"cnt_{name}"))
        out.append((pick("_cs", "_hi") - pick("_cs", name)).cast("double").alias(f"sum_{name}"))
    return run.groupBy(key, F.col("_id").alias(row_id)).agg(*out)
