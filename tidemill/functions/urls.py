"""URL parts and numeric URL features as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as "has a scheme" and as an IP host.
HAS_SCHEME = r"^\w*:?//.+"
IP_HOST = r"^\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(:\d+)?$"
SHAPE = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def parts(url: Column | str) -> dict[str, Column]:
    """scheme, netloc, path, params, query, fragment; a missing part is ''.

    A text without a scheme is read as starting at the host. ``params`` follow a ';' in the last path segment.
    """
    raw = F.col(url) if isinstance(url, str) else url
    full = F.when(raw.rlike(HAS_SCHEME), raw).otherwise(F.concat(F.lit("//"), raw))
    pick = lambda i: F.regexp_extract(full, SHAPE, i)
    path = pick(3)
    return {
        "scheme": F.lower(pick(1)),
        "netloc": pick(2),
        "path": F.regexp_replace(path, r";[^/]*$", ""),
        "params": F.regexp_extract(path, r";([^/]*)$", 1),
        "query": pick(4),
        "fragment": pick(5),
    }


def features(url: Column | str) -> dict[str, Column]:
    """Length, host, path and query features of a URL."""
    raw = F.col(url) if isinstance(url, str) else url
    p = parts(raw)
    count = lambda c, pattern: F.regexp_count(c, F.lit(pattern))
    return {
        "len": F.length(raw),
        "is_ip": p["netloc"].rlike(IP_HOST).cast("int"),
        "domain_level": count(p["netloc"], r"\.") + 1,
        "domain_len": F.length(p["netloc"]),
        "has_port": p["netloc"].rlike(r":\d+").cast("int"),
        "path_level": count(p["path"], "/"),
        "path_len": F.length(p["path"]),
        "num_query_params": count(p["query"], "&"),
        "query_len": F.length(p["query"]),
        "count_percent": count(raw, "%"),
    }
