"""Geo queries. The tables hold no coordinates, so stations and zones get theirs from their keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import haversine
from ..operators import spatial as G
from ..sources.tables import Tables
from .registry import job

# The city centre distances are measured from (lat, lon).
CENTRE_LAT, CENTRE_LON = 55.751244, 37.618423

LON = "37 + (({k} * 7919) % 10007) / 10007.0::DOUBLE"
LAT = "55 + (({k} * 104729) % 10009) / 10009.0::DOUBLE"
KM = """asin(sqrt(least(pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat))
 * pow(sin(radians({b}.lon - {a}.lon) / 2), 2), 1.0))) * 12742.0"""


def _lon(k: Column) -> Column:
    return F.lit(37.0) + ((k * 7919) % 10007) / F.lit(10007.0)


def _lat(k: Column) -> Column:
    return F.lit(55.0) + ((k * 104729) % 10009) / F.lit(10009.0)


STATIONS = f"""st AS (SELECT 'C' || c_custkey AS id, c_custkey AS k, {LON.format(k='c_custkey')} AS lon, {LAT.format(k='c_custkey')} AS lat FROM customer
 UNION ALL SELECT 'S' || s_suppkey, s_suppkey + 500, {LON.format(k='(s_suppkey + 500)')}, {LAT.format(k='(s_suppkey + 500)')} FROM supplier)"""


def _customers(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    return t.customer.select(k.alias("id"), _lon(k).alias("lon"), _lat(k).alias("lat"))


def _station(letter: str, key: str, shift: int = 0) -> list[Column]:
    k = F.col(key) + shift
    return [F.concat(F.lit(letter), F.col(key).cast("string")).alias("id"), _lon(k).alias("lon"), _lat(k).alias("lat")]


# A zone per nation: a quadrilateral of a 5 x 5 layout, neighbours overlapping a little.
CORNERS = [(0.0, 0.01), (0.215, 0.0), (0.21, 0.19), (0.02, 0.205)]
ZONES = """z AS (SELECT n_nationkey AS zone, 37 + 0.2 * (n_nationkey % 5) AS x, 55 + 0.2 * (n_nationkey // 5) AS y FROM nation WHERE n_nationkey <> 12)"""
_EDGES = " + ".join(
    f"CASE WHEN ((y + {CORNERS[i][1]} > lat) <> (y + {CORNERS[(i + 1) % 4][1]} > lat)) AND lon < ((x + {CORNERS[(i + 1) % 4][0]}) - (x + {CORNERS[i][0]})) "
    f"* (lat - (y + {CORNERS[i][1]})) / ((y + {CORNERS[(i + 1) % 4][1]}) - (y + {CORNERS[i][1]})) + (x + {CORNERS[i][0]}) THEN 1 ELSE 0 END"
    for i in range(4)
)


def _zones(t: Tables) -> DataFrame:
    k = F.col("n_nationkey")
    x, y = F.lit(37.0) + 0.2 * (k % 5), F.lit(55.0) + 0.2 * F.floor(k / 5)
    ring = F.array(*[F.struct((x + dx).alias("x"), (y + dy).alias("y")) for dx, dy in CORNERS])
    return t.nation.where("n_nationkey <> 12").select(k.alias("zone"), F.array(ring).alias("rings"))


@job(
    "haversine",
    f"""WITH {STATIONS}, c AS (SELECT {CENTRE_LAT} AS lat, {CENTRE_LON} AS lon)
    SELECT st.k AS id, round({KM.format(a='c', b='st')}, 6) AS km FROM st, c WHERE id LIKE 'C%'""",
)
def haversine_km(t: Tables) -> DataFrame:
    """Distance of every place from the centre."""
    d = haversine(F.lit(CENTRE_LON), F.lit(CENTRE_LAT), F.col("lon"), F.col("lat"))
    return _customers(t).select("id", F.round(d, 6).alias("km"))


@job(
    "nearest_to_centre",
    f"""WITH {STATIONS}, c AS (SELECT {CENTRE_LAT} AS lat, {CENTRE_LON} AS lon)
    SELECT st.k AS id, round({KM.format(a='c', b='st')}, 6) AS km FROM st, c WHERE id LIKE 'C%' ORDER BY km, id LIMIT 10""",
)
def nearest_to_centre(t: Tables) -> DataFrame:
    """The ten places nearest to the centre."""
    return G.nearest_to(_customers(t), "id", "lon", "lat", (CENTRE_LON, CENTRE_LAT), 10)


@job(
    "zone_join",
    f"""WITH {STATIONS}, {ZONES} SELECT st.k AS id, zone FROM st, z WHERE id LIKE 'C%' AND ({_EDGES}) % 2 = 1""",
)
def zone_join(t: Tables) -> DataFrame:
    """Every (point, zone) with the point inside the zone."""
    return G.zone_matches(_customers(t), _zones(t), "zone", "lon", "lat", 0.2).select("id", "zone")


@job(
    "zone_left_join",
    f"""WITH {STATIONS}, {ZONES}, h AS (SELECT st.k AS id, min(zone) AS zone FROM st, z WHERE id LIKE 'C%' AND ({_EDGES}) % 2 = 1 GROUP BY 1)
    SELECT c_custkey AS id, zone FROM customer LEFT JOIN h ON h.id = c_custkey""",
)
def zone_left_join(t: Tables) -> DataFrame:
    """First containing zone of every point, NULL outside all zones."""
    return G.zone_of(_customers(t), _zones(t), "id", "zone", "lon", "lat", 0.2)


def _trips(t: Tables) -> DataFrame:
    """A trip per order line, from its supplier's station to its customer's."""
    lines = t.lineitem.select("l_orderkey", "l_suppkey")
    orders = t.orders.select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("l_suppkey", "o_custkey")


@job(
    "zone_trip_totals",
    f"""WITH {STATIONS}, {ZONES}, tr AS (SELECT 'S' || l_suppkey AS a, 'C' || o_custkey AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    h AS (SELECT id, min(zone) AS zone FROM st, z WHERE ({_EDGES}) % 2 = 1 GROUP BY 1),
    n AS (SELECT a AS id, count(*) AS starts, 0 AS ends FROM tr GROUP BY 1 UNION ALL SELECT b, 0, count(*) FROM tr GROUP BY 1)
    SELECT zone, CAST(sum(starts) AS BIGINT) AS starts, CAST(sum(ends) AS BIGINT) AS ends FROM n LEFT JOIN h USING (id) GROUP BY 1""",
)
def zone_trip_totals(t: Tables) -> DataFrame:
    """Trip starts and ends summed per zone (NULL: outside all zones), busiest first."""
    trips = _trips(t)
    starts = trips.select(*_station("S", "l_suppkey", 500))
    ends = trips.select(*_station("C", "o_custkey"))
    return G.zone_totals(starts, ends, _zones(t), "id", "zone", "lon", "lat", 0.2)


@job(
    "distance_stats",
    f"""WITH {STATIONS}, d AS (SELECT {KM.format(a='a', b='b')} AS km FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    JOIN st a ON a.id = 'S' || l_suppkey JOIN st b ON b.id = 'C' || o_custkey WHERE a.k <> b.k)
    SELECT round(max(km), 6) AS max_km, round(avg(km), 6) AS mean_km, round(stddev_samp(km), 6) AS std_km, round(median(km), 6) AS median_km FROM d""",
)
def distance_stats(t: Tables) -> DataFrame:
    """Trip distances, trips within one station left out."""
    start, end = F.col("l_suppkey") + 500, F.col("o_custkey")
    km = haversine(_lon(start), _lat(start), _lon(end), _lat(end))
    trips = _trips(t).where(start != end).select(km.alias("km"))
    out = G.distance_stats(trips, "km")
    return out.select(*[F.round(c, 6).alias(c) for c in out.columns])


_PAIRS = f"""WITH {STATIONS}, p AS (SELECT a.k AS id1, b.k AS id2, round({KM.format(a='a', b='b')}, 6) AS km FROM st a JOIN st b ON a.k < b.k
 WHERE a.id LIKE 'C%' AND b.id LIKE 'C%')"""


@job("nearest_pairs", f"{_PAIRS} SELECT * FROM p ORDER BY km, id1, id2 LIMIT 10")
def nearest_pairs(t: Tables) -> DataFrame:
    """The ten nearest pairs of places."""
    return G.extreme_pairs(_customers(t), "id", "lon", "lat", 10)


@job("farthest_pairs", f"{_PAIRS} SELECT * FROM p ORDER BY km DESC, id1, id2 LIMIT 10")
def farthest_pairs(t: Tables) -> DataFrame:
    """The ten farthest pairs of places."""
    return G.extreme_pairs(_customers(t), "id", "lon", "lat", 10, farthest=True)
