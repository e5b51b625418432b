"""Not-modified captures resolved to the full responses that they stand for.

A capture of status 304 carries no payload. It stands for the latest earlier full response of the same canonical URL, found by
an as-of join: captures are ordered by (URL, time), cut into slices of even size whatever URL is hot, and the latest response is
carried over rows and slices. The validators must agree, and the headers that a 304 may update replace the stored ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import forward_fill

#: Header fields of a 304 that update the stored response (RFC 9110, 15.4.5).
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: Status codes of a full response.
FULL = (200, 203)


def canonical_url(url: Column) -> Column:
    """Host in lower case without ``www.`` and the scheme's own port, path without a slash at its end, query without tracking
    fields; scheme and fragment go. Null for what has no scheme and host."""
    u = F.regexp_replace(F.trim(url), r"#.*$", "")
    whole = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?]*)([^?]*)(\?.*)?$"
    scheme, host, path, query = (F.regexp_extract(u, whole, i) for i in (1, 2, 3, 4))
    own_port = F.when(F.lower(scheme) == "https", F.regexp_replace(host, r":443$", "")).otherwise(F.regexp_replace(host, r":80$", ""))
    host = F.regexp_replace(F.lower(own_port), r"^www\.", "")
    query = F.regexp_replace(query, r"([?&])(utm_[a-z]+|fbclid|gclid)=[^&]*", "$1")
    query = F.regexp_replace(F.regexp_replace(F.regexp_replace(query, r"&+", "&"), r"\?&", "?"), r"[?&]$", "")
    return F.when(host != "", F.concat(host, F.regexp_replace(path, r"/+$", ""), query))


def lower_names(headers: Column) -> Column:
    """Header map with lower-case names; of names that differ in case only the last one in byte order counts."""
    entries = F.array_sort(F.map_entries(headers))
    names = F.array_distinct(F.transform(entries, lambda e: F.lower(e["key"])))
    last = F.transform(names, lambda n: F.element_at(F.filter(entries, lambda e: F.lower(e["key"]) == n), -1)["value"])
    return F.map_from_arrays(names, last)


def _tag(headers: Column) -> Column:
    return F.regexp_replace(headers["etag"], "^W/", "")


def resolve(captures: DataFrame, permitted: tuple[str, ...] = PERMITTED, full: tuple[int, ...] = FULL) -> DataFrame:
    """capture_id, url (canonical), fetch_time, outcome, response_id and headers of every row of ``captures``
    (capture_id, url, fetch_time, status, headers).

    ``outcome`` is ``response`` for a full response (its own response_id), ``resolved`` for a 304 whose latest earlier response
    has its validators (the entity tag, compared weakly; without one the last-modified date; with neither any response will
    do), ``mismatch`` if it has others, ``no_response`` if there is none, and ``other`` for any other status. A resolved
    capture has the response's headers, with those of ``permitted`` that the 304 sends in their place; others keep their own.

    Earlier means a smaller (fetch_time, capture_id). A row whose URL, time or capture_id is null, or whose URL is malformed, neither finds
    a response nor is one for others. Null headers count as none. Repeated rows are each resolved. An empty table gives no
    rows. Other columns are ignored.
    """
    none = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    rows = captures.select(
        F.col("capture_id").cast("long").alias("capture_id"),
        canonical_url(F.col("url")).alias("url"),
        F.col("fetch_time"),
        F.col("status").cast("int").alias("status"),
        F.coalesce(lower_names(F.col("headers")), none).alias("own"),
    )
    is_full = F.coalesce(F.col("status").isin(*full), F.lit(False))
    ready = F.col("url").isNotNull() & F.col("fetch_time").isNotNull() & F.col("capture_id").isNotNull()
    stored = F.when(is_full, F.struct(F.col("capture_id").alias("id"), F.col("own").alias("headers")))
    filled = forward_fill(rows.where(ready).withColumn("stored", stored), ["url"], ["fetch_time", "capture_id"], "stored", "found")
    found = filled.drop("stored").unionByName(rows.where(~ready).withColumn("found", F.lit(None)), allowMissingColumns=True)

    old = F.col("found.headers")
    own = F.col("own")
    agrees = (
        F.when(own["etag"].isNotNull(), F.coalesce(_tag(own) == _tag(old), F.lit(False)))
        .when(own["last-modified"].isNotNull(), F.coalesce(own["last-modified"] == old["last-modified"], F.lit(False)))
        .otherwise(F.lit(True))
    )
    outcome = (
        F.when(is_full, "response")
        .when(~F.coalesce(F.col("status") == 304, F.lit(False)), "other")
        .when(F.col("found").isNull(), "no_response")
        .when(agrees, "resolved")
        .otherwise("mismatch")
    )
    sent = F.map_filter(own, lambda k, v: k.isin(*permitted))
    kept = F.map_filter(old, lambda k, v: ~F.array_contains(F.map_keys(sent), k))
    return found.withColumn("outcome", outcome).select(
        "capture_id",
        "url",
        "fetch_time",
        "outcome",
        F.when(F.col("outcome") == "response", F.col("capture_id")).when(F.col("outcome") == "resolved", F.col("found.id")).alias("response_id"),
        F.when(F.col("outcome") == "resolved", F.map_concat(kept, sent)).otherwise(own).alias("headers"),
    )
