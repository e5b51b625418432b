"""Dated URL lists joined to captures as they stood when each capture was fetched.

The dated entries of a list become validity intervals: an entry holds from its date until the next entry of the same list and
pattern. An as-of join then gives each capture, for every pattern that its URL can match, the interval that began last, if it still holds.
Both steps work on slices of even size, so neither a hot host nor a pattern with very many entries meets one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import forward_fill, previous_value
from ..session import cut_lineage

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    """Host in lower case, or an empty string."""
    return F.lower(F.regexp_extract(F.trim(url), HOST, 1))


def path_of(url: Column) -> Column:
    """Path without slashes at its end."""
    return F.regexp_replace(F.regexp_extract(F.trim(url), PATH, 1), "/+$", "")


def probes(url: Column, deepest: int) -> Column:
    """What patterns can match ``url``: its host and the domains above it, and host with path cut at each slash, of
    at most ``deepest`` path parts."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), ".")
    )
    parts = F.slice(F.split(F.substring(path_of(url), 2, 1 << 30), "/"), 1, max(deepest, 1))
    paths = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, i), "/"))
    )
    some_path = (path_of(url) != "") & F.lit(deepest > 0)
    return F.when(host != "", F.when(some_path, F.concat(domains, paths)).otherwise(domains))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """list, pattern, entry_id, valid_from and valid_to (null: still open) of the ``add`` entries of ``entries``
    (entry_id, list, pattern, action, entry_time).

    An entry holds until the next one of the same list and pattern, by (entry_time, entry_id): a ``remove`` ends it and another ``add``
    takes its place. Entries with a null or another action are left out; repeated rows give intervals of no length but one.
    """
    named = entries.select(
        F.col("entry_id").cast("long").alias("entry_id"), "list", F.lower(F.trim("pattern")).alias("pattern"), "action",
        F.col("entry_time").cast("long").alias("valid_from"),
    )
    whole = named.dropna().where(F.col("action").isin("add", "remove") & (F.col("pattern") != ""))
    turned = whole.withColumns({"_time": -F.col("valid_from"), "_id": -F.col("entry_id")})
    later = previous_value(turned, ["list", "pattern"], ["_time", "_id"], "valid_from", "valid_to")
    held = later.where((F.col("action") == "add") & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from"))))
    return held.select("list", "pattern", "entry_id", "valid_from", "valid_to")


def evaluate(captures: DataFrame, entries: DataFrame, first_list: str = "allow") -> DataFrame:
    """capture_id, decision, entry_id, pattern and n_active of every row of ``captures`` (capture_id, url, fetch_time).

    A pattern is a host, which matches itself and what is below it, or a host and path, which matches that path and what is below it.
    Of the entries active at fetch time (from their date on, up to but not with their end) the one with the longest pattern
    decides; of equals that of list ``first_list``, then the list of the last name, then the largest entry_id. ``decision`` is the name of its list, or
    ``none``. ``n_active`` counts the active entries that match.

    A null or malformed URL or a null time matches nothing. A null capture_id is kept. Repeated rows are each evaluated. With no entries every
    decision is ``none``; an empty table gives no rows. Other columns are ignored.
    """
    rows = captures.select(
        F.col("capture_id").cast("long").alias("capture_id"), F.col("url").cast("string").alias("url"), F.col("fetch_time").cast("long").alias("at")
    )
    rows = cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()))
    held = cut_lineage(validity_intervals(entries))
    deepest = held.agg(F.max(F.size(F.split("pattern", "/")) - 1)).first()[0] or 0
    asked = rows.where("at is not null").select("row", "at", F.explode(probes(F.col("url"), deepest)).alias("pattern"))
    asked = asked.distinct().join(held.select("list", "pattern").distinct(), "pattern")

    starts = held.select(
        "list", "pattern", F.col("valid_from").alias("at"), F.lit(0).alias("kind"), F.col("entry_id").alias("nr"),
        F.struct("entry_id", "valid_to").alias("start"),
    )
    points = asked.select("list", "pattern", "at", F.lit(1).alias("kind"), F.col("row").alias("nr"))
    line = starts.unionByName(points, allowMissingColumns=True)
    joined = forward_fill(line, ["list", "pattern"], ["at", "kind", "nr"], "start", "found")
    until = F.col("found.valid_to")
    active = joined.where((F.col("kind") == 1) & F.col("found").isNotNull() & (until.isNull() | (F.col("at") < until)))
    best = F.struct(
        F.length("pattern").alias("size"), (F.col("list") == first_list).alias("first"), "list", F.col("found.entry_id").alias("entry_id"), "pattern"
    )
    decided = active.groupBy(F.col("nr").alias("row")).agg(F.max(best).alias("best"), F.count(F.lit(1)).alias("n"))
    return rows.join(decided, "row", "left").select(
        "capture_id",
        F.coalesce("best.list", F.lit("none")).alias("decision"),
        F.col("best.entry_id").alias("entry_id"),
        F.col("best.pattern").alias("pattern"),
        F.coalesce("n", F.lit(0)).alias("n_active"),
    )
