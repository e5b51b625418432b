"""Jaccard join of documents on word shingles by parity sketches, and the classes that its links form.

A parity sketch hashes each shingle of a set to one bit and keeps every bit's parity. Two sketches differ in at most
as many bits as their sets differ in shingles, and Jaccard similarity J limits that difference d for sets of n and m
shingles: d <= (n + m) (1 - J) / (1 + J). Documents are put in bands by size; for a band the largest d is
known, and the sketch is cut into ``d + 1 + spare`` segments. By the pigeonhole principle two linked documents agree in
``1 + spare`` segments or more. Segments without an odd bit, or of common shingles alone, say little and are not used as
keys: a document with at most ``spare`` of them still meets every partner in a key, and one with more is sketched again
with other numbers, as its like are, until it has few enough (in the end common shingles are taken like all others). So no link is missed.

Segments have many bits but few odd ones, so a segment is kept as the XOR of one random value for each odd bit.

Documents that share a key form a group. A group is a star around its smallest doc_id, found in a sorted stream. Pairs are
first held to their sizes and to a short whole sketch, whose Hamming distance may not be more than a link allows. The first
round then verifies each document against the centre it shares most keys with, and the second against other centres that it
is still apart from. What is linked by then needs no further comparison; the third round takes the pairs within a group whose documents are apart and whose
sketches allow a link. These pairs stay in the task that finds them: it gives back which documents they connect, a row a
document, and documents so connected are held to each other by their exact sets, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache
from math import ceil, floor, sqrt

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import components
from ..session import cut_lineage, fits, small_side
from .common import id_and_text, rows
from .shingles import Shingler, mix

#: Bits of one segment, as a power of two.
SEGMENT_BITS = 16
#: Documents that share one copy of the set they are compared with.
MEMBERS = 256
#: Documents of one group that are held to each other in one piece of work.
GROUP_DOCS = 2_000
#: Pairs, and words of sketches, that a task lays out at a time when it holds a group's documents to each other.
PAIRS, WORDS = 100_000, 500_000
#: Documents, and shingles, of a block of documents whose exact sets are held to each other.
BLOCK_DOCS, BLOCK_SHINGLES = 256, 500_000
BAND = Fraction(5, 4)
#: Shares of common shingles that the first sketches of a set allow for.
COMMON_SHARES = (0.0, 0.35, 0.55)
#: Common shingles: those that ``COMMON_LEAST`` of about ``COMMON_DOCS`` documents hold, at most ``COMMON_MOST`` of them. They only
#: save work: links are found whatever shingles are called common.
COMMON_DOCS, COMMON_LEAST, COMMON_MOST = 10_000, 6, 100_000
DOC, SEGMENT, COPY, EMPTY, NAMELESS = 0, 1, 2, 3, 4


class Bands:
    """Sizes as bands, and for each band's scheme the number of segments and of segments that may be blank."""

    def __init__(self, least: Fraction):
        self.least = least

    @lru_cache(maxsize=None)  # noqa: B019  one object for each task
    def schemes(self, n: int) -> list[tuple[int, int]]:
        """(first, last) size of the bands in whose schemes a set of n shingles takes part: those that hold the smaller size of
        some pair that n may be in."""
        out, low = [], 1
        while low <= n:
            high = max(low, floor(low * BAND) - 1)
            if n <= floor(high / self.least):
                out.append((low, high))
            low = high + 1
        return out

    @lru_cache(maxsize=None)  # noqa: B019
    def attempts(self, low: int, high: int) -> list[tuple[int, int, bool]]:
        """(segments, spare, whether segments of common shingles alone are blank) of the sketches that a set goes through
        until it has few enough blank ones: for more and more common shingles, and then with these like all others."""
        apart = floor((high + floor(high / self.least)) * (1 - self.least) / (1 + self.least))
        if not apart:
            return [(1, 0, False)]
        fitted = [self._fitted(apart, low * (1 - share)) for share in COMMON_SHARES]
        plain = self._fitted(apart, low) or (3 * apart + 3, 2 * apart + 2)
        return [(*f, True) for f in fitted if f] + [(*plain, False)]

    def prefixed(self, low: int, high: int) -> bool:
        """True for a band whose smallest sets may have too few shingles for as many odd segments as a pair may be apart: there the
        keys are single shingles (see ``_keys``). Both sets of a pair ask for the same band, so they agree."""
        apart = floor((high + floor(high / self.least)) * (1 - self.least) / (1 + self.least))
        return low <= apart or (apart >= 4 and low < 2 * (apart + 1))

    @staticmethod
    def _fitted(apart: int, telling: float) -> tuple[int, int] | None:
        """The fewest segments, and how many may be blank, that most sets of ``telling`` shingles keep to."""
        margin = 1.0 if apart > 5 else 0.5
        for spare in range(2 * apart + 3):
            count = apart + 1 + spare
            blank = count * (1 - 1 / count) ** telling
            if spare >= blank + margin * sqrt(blank):
                return count, spare
        return None


#: A random value for each bit of a segment.
_BITS = mix(np.arange(1, 2**SEGMENT_BITS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _keys(shingles: np.ndarray, common: np.ndarray, bands: Bands) -> np.ndarray:
    """The keys of one set (sorted, evenly spread values; ``common`` marks some), over all its schemes: segments, or in the
    bands of ``Bands.prefixed`` its smallest shingles, so many that two sets that link share one of them."""
    out = []
    values = [(shingles, ~common)]  # by seed; sorted, so that segments are runs
    for low, high in bands.schemes(len(shingles)):
        if bands.prefixed(low, high):
            smallest = shingles[: len(shingles) - ceil(bands.least * len(shingles)) + 1]
            out.append(mix(smallest ^ mix(np.array([(low << 8) + 255], dtype=np.uint64))))
            continue
        attempts = bands.attempts(low, high)
        nr = 0
        while True:
            count, spare, telling_only = attempts[min(nr, len(attempts) - 1)]
            seed = max(0, nr - len(attempts) + 1)
            if seed == len(values):
                turned = mix(shingles ^ mix(np.array([seed], dtype=np.uint64)))
                order = np.argsort(turned)
                values.append((turned[order], ~common[order]))
            value, telling = values[seed]
            segment = ((value >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
            starts = np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))
            parity = np.bitwise_xor.reduceat(_BITS[value & np.uint64(2**SEGMENT_BITS - 1)], starts)
            odd = parity != 0
            if telling_only:
                odd &= np.logical_or.reduceat(telling, starts)
            place = (segment[starts[odd]] << np.uint64(32)) ^ np.uint64((low << 8) + nr)
            out.append(mix(parity[odd] ^ mix(place)))
            if count - int(odd.sum()) <= spare:
                break
            nr += 1
    return np.concatenate(out)


def _sketch(shingles: np.ndarray, low: int) -> np.ndarray:
    """Parity of two bits for each shingle of the band's first size, as 64-bit words: a lower bound of how far two sets are apart."""
    width = -(-2 * low // 64) * 64
    place = ((shingles >> np.uint64(16)) & np.uint64(2**32 - 1)) * np.uint64(width) >> np.uint64(32)
    return np.packbits(np.bincount(place.astype(np.int64), minlength=width) & 1).view(np.int64)


#: ``info`` is null for segments; else, as 64-bit numbers: n, mark (a second value of the set, or the centre of a copy), first size of
#: the own band, and for each scheme its first size, the number of words of its sketch, and these.
SKETCH = "kind byte, key long, doc long, info binary"


def common_shingles(docs: DataFrame, width: int, sample: int = COMMON_DOCS, at_least: int = COMMON_LEAST, most: int = COMMON_MOST) -> np.ndarray:
    """Shingles that many of a sample of documents hold, sorted; a bounded list, counted by Spark."""
    texts = id_and_text(docs)
    share = int(1e6 * min(1.0, sample / max(1, docs.count())))
    some = texts.where(F.pmod(F.xxhash64("doc_id", F.lit("common")), F.lit(1_000_000)) < share)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            held, size = [], 0
            for i, (_, data) in enumerate(rows(batch)):
                held.append(shingler(data or b""))
                size += len(held[-1])
                if size > 500_000 or i + 1 == batch.num_rows:
                    value, n = np.unique(np.concatenate(held), return_counts=True)
                    yield pa.record_batch([pa.array(value.view(np.int64)), pa.array(n.astype(np.int64))], names=["shingle", "n"])
                    held, size = [], 0

    counted = some.mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= at_least)
    found = counted.orderBy(F.desc("n"), "shingle").limit(most).select("shingle").collect()
    return np.sort(np.array([r.shingle for r in found], dtype=np.int64).view(np.uint64))


def _sketches(width: int, least: Fraction, common_list: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, bands = Shingler(width), Bands(least)
        common = np.append(np.frombuffer(common_list.value, dtype=np.uint64), np.uint64(2**64 - 1))
        for batch in batches:
            docs, keys, of, held = {}, [], [], 0
            out: list[tuple] = []
            for doc, data in rows(batch, by_id=True):
                s = shingler(data or b"")
                if doc is None or not len(s):
                    out.append((EMPTY if doc is not None else NAMELESS, len(out), doc or 0, _info(len(s), 0, 0)))
                    continue
                sign = int(np.bitwise_xor.reduce(mix(s))), int(mix(s + np.uint64(7)).sum(dtype=np.uint64)), len(s)
                first = docs.setdefault(sign, doc)
                if first != doc:  # an equal set in this batch has been sketched
                    out.append((COPY, doc, doc, _info(len(s), first, 0)))
                    continue
                lows = [low for low, _ in bands.schemes(len(s))]
                sketches = [np.concatenate([[low, len(w)], w]) for low in lows for w in [_sketch(s, low)]]
                out.append((DOC, _signed(sign[0]), doc, _info(len(s), _signed(sign[1]), lows[-1]) + np.concatenate(sketches).tobytes()))
                own = _keys(s, common[np.searchsorted(common[:-1], s)] == s, bands)
                keys.append(own)
                of.append((doc, len(own)))
                held += len(own)
                if held > 250_000:
                    yield _segments(keys, of)
                    keys, of, held = [], [], 0
            yield _records(out)
            if keys:
                yield _segments(keys, of)

    return run


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def _info(n: int, mark: int, low: int) -> bytes:
    return np.array([n, mark, low], dtype=np.int64).tobytes()


def _records(out: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int8(), pa.int64(), pa.int64(), pa.binary()]
    columns = list(zip(*out)) if out else [[]] * 4
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["kind", "key", "doc", "info"])


def _segments(keys: list[np.ndarray], of: list[tuple[int, int]]) -> pa.RecordBatch:
    key = np.concatenate(keys).view(np.int64)
    doc = np.repeat(np.array([d for d, _ in of], dtype=np.int64), [n for _, n in of])
    kind = np.full(len(key), SEGMENT, dtype=np.int8)
    return pa.record_batch([pa.array(kind), pa.array(key), pa.array(doc), pa.nulls(len(key), pa.binary())], names=["kind", "key", "doc", "info"])


STARS = "kind byte, key long, doc long, centre long, n long, own long, sketches array<struct<low: long, bits: array<long>>>"


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (key, kind, doc): every document once with the first of its equal sets as centre, and
    of groups with two documents or more a row (key, doc, centre) for each but the centre."""
    last = None  # kind, key, doc of the row before, centre of its group
    sketch = pa.list_(pa.struct([("low", pa.int64()), ("bits", pa.list_(pa.int64()))]))
    names = ["kind", "key", "doc", "centre", "n", "own", "sketches"]
    marks: dict[int, int] = {}  # of the centres of the group of equal sets that is going on
    for batch in batches:
        if not batch.num_rows:
            continue
        kind, key, doc = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("kind", "key", "doc"))
        new = np.append(True, (kind[1:] != kind[:-1]) | (key[1:] != key[:-1]))
        goes_on = last is not None and last[:2] == (kind[0], key[0])
        at = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
        centre = doc[at]
        if goes_on:
            centre[at == 0] = last[3]
            new[0] = False
        last = kind[-1], key[-1], doc[-1], centre[-1]
        keep = (kind == SEGMENT) & ~new & (doc != centre)
        again = np.append(False, (doc[1:] == doc[:-1]) & ~new[1:])  # one document twice in a group
        keep &= ~again
        size = int(keep.sum())
        empty = [pa.nulls(size, pa.int64()), pa.nulls(size, pa.int64()), pa.nulls(size, sketch)]
        yield pa.record_batch([*[pa.array(a[keep]) for a in (kind, key, doc, centre)], *empty], names=names)
        out = []
        for i in np.flatnonzero(kind != SEGMENT).tolist():
            info = np.frombuffer(batch.column("info")[i].as_py(), dtype=np.int64)
            n, mark, own = info[:3].tolist()
            to = int(doc[i])
            if kind[i] == COPY:
                to = mark
            elif kind[i] == DOC:
                if new[i]:
                    marks = {mark: to}
                to = marks.setdefault(mark, to)
            found, place = [], 3
            while place < len(info):
                low, words = info[place : place + 2].tolist()
                found.append({"low": low, "bits": info[place + 2 : place + 2 + words].tolist()})
                place += 2 + words
            out.append((int(kind[i]), int(key[i]), None if kind[i] == NAMELESS else int(doc[i]), to, n, own, found))
            if len(out) == 5000:
                yield _members(out, names, sketch)
                out = []
        if out:
            yield _members(out, names, sketch)


def _members(out: list[tuple], names: list[str], sketch: pa.DataType) -> pa.RecordBatch:
    kinds = [pa.int8(), *[pa.int64()] * 5, sketch]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def _within_reach(pairs: DataFrame, members: DataFrame, least: Fraction) -> DataFrame:
    """Pairs (doc, centre) whose sizes, and whose sketches for the smaller one's band, allow a link."""
    other = members.select(F.col("doc").alias("centre"), F.col("n").alias("m"), F.col("own").alias("own2"), F.col("sketches").alias("sketches2"))
    met = pairs.join(members, "doc").join(other, "centre")
    num, den = least.numerator, least.denominator
    fits = F.least("n", "m") * den >= F.greatest("n", "m") * num
    apart = F.floor((F.col("n") + F.col("m")) * (den - num) / (den + num) + 1e-9)
    low = F.least("own", "own2")
    mine, theirs = (F.try_element_at(F.filter(c, lambda x: x["low"] == low), F.lit(1))["bits"] for c in ("sketches", "sketches2"))
    differ = F.aggregate(F.zip_with(mine, theirs, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    return met.where(fits).where(differ <= apart).select("doc", "centre").distinct()


def _verify(docs: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """(doc, centre, common, n, m): exact sizes for each pair (doc, centre); sets of one centre come as a sorted stream, in
    shares of bounded size that each begin with a copy of the centre's set."""
    pairs = cut_lineage(pairs)  # used three times
    sizes = pairs.groupBy("centre").agg((F.floor(F.count(F.lit(1)) / MEMBERS) + 1).alias("shares"))
    sized = pairs.join(small_side(sizes), "centre")
    members = sized.select(
        F.col("doc").alias("want"), "centre", F.pmod(F.xxhash64("doc"), F.col("shares")).alias("share"), F.lit(False).alias("first")
    )
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share")
    firsts = sizes.select(F.col("centre").alias("want"), "centre", copies, F.lit(True).alias("first"))
    wanted = cut_lineage(members.unionByName(firsts))
    piece = F.when(F.col("first"), F.floor(F.col("share") / 1024)).otherwise(-1)  # lists of bounded length
    wanted = wanted.groupBy("want", piece.alias("piece")).agg(F.collect_list(F.struct("centre", "share", "first")).alias("places"))
    found = id_and_text(docs).join(small_side(wanted), F.col("doc_id") == F.col("want")).select("doc_id", "text", "places")
    shape = "doc long, centre long, share long, first boolean, items binary"

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            for (doc, data), places in zip(rows(batch), batch.column("places")):
                items = shingler(data or b"").tobytes()
                listed = places.as_py()
                for at in range(0, len(listed), 100):
                    some = listed[at : at + 100]
                    columns = [[doc] * len(some), *[[p[k] for p in some] for k in ("centre", "share", "first")], [items] * len(some)]
                    yield pa.record_batch(columns, names=["doc", "centre", "share", "first", "items"])

    order = ["centre", "share"]
    stream = found.mapInArrow(sets, shape).repartition(*order).sortWithinPartitions(*order, F.desc("first"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, against = None, []  # a doc_id that repeats has several sets
        for batch in batches:
            out = []
            places = zip(*[batch.column(c).to_pylist() for c in ("doc", "centre", "share", "first")])
            for (doc, centre, share, first), value in zip(places, batch.column("items")):
                own = np.frombuffer(value.as_py(), dtype=np.uint64)
                if at != (centre, share):
                    at, against = (centre, share), []
                if first:
                    against.append(own)
                    continue
                for other in against:
                    if len(own) and len(other):
                        near = np.searchsorted(other, own)
                        near[near == len(other)] = 0
                        out.append((doc, centre, int((other[near] == own).sum()), len(own), len(other)))
            columns = list(zip(*out)) if out else [[]] * 5
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["doc", "centre", "common", "n", "m"])

    return stream.mapInArrow(compare, "doc long, centre long, common long, n long, m long")


def near_components(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``.

    The set of a text: its distinct shingles of ``width`` words (A-Z lower-cased; words are runs of anything but ASCII white
    space), or all its words as one shingle if there are fewer. Two documents link when 100 * common >= ``percent`` * union.
    ``component_id`` is the least doc_id that can be reached over links, the document's own included.

    A null text, or one without words, has an empty set (0) and links with nothing. A row without doc_id links with
    nothing and has no component_id. Rows that repeat a doc_id are one document with several texts: it links where any of
    them does. An empty table gives no rows. Other columns are ignored. Shingles are told apart by 64-bit hashes.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent must be 1 to 100")
    least = Fraction(percent, 100)
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, width).tobytes())  # a list of bounded length
    dealt = id_and_text(docs).mapInArrow(_sketches(width, least, common), SKETCH)
    # Sorted by key first, as rows are compared by the first column and only then, one by one, by the others.
    placed = dealt.repartition("kind", "key").sortWithinPartitions("key", "kind", "doc")
    stars = cut_lineage(placed.mapInArrow(_stars, STARS))
    named = stars.where(F.col("kind") != SEGMENT)
    grouped = stars.where(F.col("kind") == SEGMENT).select("key", "doc", "centre")
    members = named.where(F.col("kind") == DOC).select("doc", "n", "own", "sketches")
    # A copy found within its batch needs no edge, unless its doc_id has other texts.
    repeated = named.where(F.col("kind").isin(DOC, COPY)).groupBy("doc").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    copies = named.where(F.col("kind") == COPY).join(repeated, "doc", "left_semi")
    same = named.where(F.col("kind") == DOC).unionByName(copies).where("doc <> centre").select("doc", "centre").distinct()

    counts = cut_lineage(grouped.groupBy("doc", "centre").agg(F.count(F.lit(1)).alias("keys")))
    near = cut_lineage(_within_reach(counts.select("doc", "centre"), members, least))
    # Copies follow the first of their equal sets, so only that one is compared.
    ranked = counts.join(near, ["doc", "centre"]).join(same.select("doc"), "doc", "left_anti")
    best = ranked.groupBy("doc").agg(F.max_by("centre", F.struct("keys", -F.col("centre"))).alias("centre"))
    first = cut_lineage(_verify(docs, best, width))
    linked = F.col("common") * 100 >= percent * (F.col("n") + F.col("m") - F.col("common"))
    edges = cut_lineage(same.unionByName(first.where(linked).select("doc", "centre")).distinct())
    parents = edges.groupBy("doc").agg(F.min("centre").alias("centre"))
    label = _roots(parents)
    label = _merged(label, edges.join(parents, ["doc", "centre"], "left_anti"))

    others = _with_labels(near, label).where("own <> other").select("doc", "centre")
    second = cut_lineage(_verify(docs, others.join(first.select("doc", "centre"), ["doc", "centre"], "left_anti"), width))
    label = _merged(label, second.where(linked).select("doc", "centre"))

    met = cut_lineage(_apart(grouped, counts, label, members, least))
    if not fits(met, 0):
        label = _merged(label, cut_lineage(_links_among(docs, met, label, members, least, width)))

    node = F.when(F.col("kind") == COPY, F.col("centre")).when(F.col("kind") != NAMELESS, F.col("doc"))
    out = named.withColumn("node", node).join(label, F.col("node") == F.col("id"), "left")
    return out.select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.coalesce("component", "node", "doc").alias("component_id")
    )


def _roots(parents: DataFrame) -> DataFrame:
    """Classes (id, component) of a forest (doc, centre) whose centres are smaller than their documents: every document
    takes its centre's centre until none has one."""
    jumped = cut_lineage(parents)
    while True:
        up = jumped.select(F.col("doc").alias("at"), F.col("centre").alias("above"))
        found = jumped.join(up, F.col("centre") == F.col("at"), "left")
        jumped = cut_lineage(found.select("doc", F.coalesce("above", "centre").alias("centre"), F.col("above").isNotNull().alias("moved")))
        if jumped.where("moved").isEmpty():
            return jumped.select(F.col("doc").alias("id"), F.col("centre").alias("component"))


def _merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """Classes (id, component) with those put together that ``links`` (doc, centre) connect."""
    if links.isEmpty():
        return label
    ends = _with_labels(links, label).select(F.col("own").alias("src"), F.col("other").alias("dst"))
    joined = components(ends.select(F.explode(F.array("src", "dst")).alias("id")), ends)
    joined = cut_lineage(joined.select(F.col("id").alias("component"), F.col("component").alias("to")))
    own = label.unionByName(joined.select(F.col("component").alias("id"), "component")).join(joined, "component", "left")
    return cut_lineage(own.groupBy("id").agg(F.min(F.coalesce("to", "component")).alias("component")))


def _with_labels(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """Pairs with the classes ``own`` of doc and ``other`` of centre."""
    of = label.select(F.col("id").alias("doc"), F.col("component").alias("own"))
    to = label.select(F.col("id").alias("centre"), F.col("component").alias("other"))
    pairs = pairs.join(of, "doc", "left").join(to, "centre", "left")
    return pairs.withColumns({"own": F.coalesce("own", "doc"), "other": F.coalesce("other", "centre")})


def _apart(grouped: DataFrame, counts: DataFrame, label: DataFrame, members: DataFrame, least: Fraction) -> DataFrame:
    """Pairs (doc, centre) that connect all documents which some pair connects: of two documents in a group, neither its centre,
    that are not linked so far, and whose sizes and sketches allow a link.

    A group's documents are held to each other where they lie, and what comes out grows with the documents, not with such pairs. Groups
    of more than ``GROUP_DOCS`` are cut into blocks, and each pair of blocks is a piece of work of its own.
    """
    # Only groups in which some document is apart from the centre hold pairs that are apart.
    open_stars = _with_labels(counts.select("doc", "centre"), label).where("own <> other").select("doc", "centre")
    sizes = grouped.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    keys = grouped.join(open_stars, ["doc", "centre"], "left_semi").select("key").distinct().join(sizes, "key")
    keys = cut_lineage(keys.select("key", (F.floor(F.col("size") / GROUP_DOCS) + 1).alias("blocks")))
    names = label.select(F.col("id").alias("doc"), "component")
    held = grouped.select("key", "doc").join(keys, "key").join(members, "doc").join(names, "doc", "left")
    held = held.withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")))
    held = held.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    piece = held.select(
        "key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "doc",
        F.coalesce("component", "doc").alias("component"), "n", "own", "sketches",
    )
    order = ["key", "lo", "hi"]
    stream = piece.repartition(*order).sortWithinPartitions(*order)
    return stream.mapInArrow(_held_to_each_other(least), "doc long, centre long").distinct()


def _sketch_places(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The sketches of a batch: (row, low) as one ascending number each, where its words start, how many these are, and all words."""
    low, bits = column.flatten().flatten()
    row = np.repeat(np.arange(len(column)), column.value_lengths().to_numpy(zero_copy_only=False))
    words = bits.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = bits.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    return (row << 40) + low.to_numpy(zero_copy_only=False), np.cumsum(words) - words, words, values


def _held_to_each_other(least: Fraction):
    """From rows sorted by (key, lo, hi): what the pairs within a group connect (see ``_gathered``) that are apart and whose sizes and
    sketches allow a link. Pairs are laid out ``PAIRS`` at a time, over all groups of a batch; in the order of size a row's partners
    are a stretch."""
    num, den = least.numerator, least.denominator
    names = ["doc", "centre"]

    def numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
        return batch.column(name).to_numpy(zero_copy_only=False)

    def starts_of(batch: pa.RecordBatch) -> np.ndarray:
        new = np.zeros(batch.num_rows, dtype=bool)
        new[:1] = True
        for name in ("key", "lo", "hi"):
            value = numbers(batch, name)
            new[1:] |= value[1:] != value[:-1]
        return new

    def pairs_of(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        group = np.cumsum(starts_of(batch))
        block, doc, component, n, own = (numbers(batch, c) for c in ("block", "doc", "component", "n", "own"))
        inside = numbers(batch, "lo") == numbers(batch, "hi")
        order = np.lexsort((n, group))
        size = (group[order] << 40) + n[order]
        end = np.searchsorted(size, (group[order] << 40) + n[order] * den // num, side="right")
        partners = end - np.arange(len(end)) - 1
        total = np.cumsum(partners)
        sketch, place, words, values = _sketch_places(batch.column("sketches"))
        at, ends = 0, (doc[:0], doc[:0])
        while at < len(order):
            before = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, before + PAIRS, side="right")))
            count = partners[at:to]
            i = np.repeat(np.arange(at, to), count)
            j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(count) - count, count)
            at = to
            x, y = order[i], order[j]
            some = (component[x] != component[y]) & (doc[x] != doc[y]) & (inside[x] | (block[x] != block[y]))
            x, y = x[some], y[some]
            if not len(x):
                continue
            low = own[x]  # of the smaller one
            mine, theirs = (np.minimum(np.searchsorted(sketch, (r << 40) + low), len(sketch) - 1) for r in (x, y))
            there = (sketch[mine] == (x << 40) + low) & (sketch[theirs] == (y << 40) + low)
            x, y, mine, theirs = x[there], y[there], mine[there], theirs[there]
            most = (n[x] + n[y]) * (den - num) // (den + num)
            near = np.zeros(len(x), dtype=bool)
            for width in np.unique(words[mine]).tolist():
                of = np.flatnonzero(words[mine] == width)
                step = max(1, WORDS // width)
                for some in (of[k : k + step] for k in range(0, len(of), step)):
                    word = np.arange(width)
                    differ = values[place[mine[some], None] + word] ^ values[place[theirs[some], None] + word]
                    near[some] = np.bitwise_count(differ).sum(axis=1, dtype=np.int64) <= most[some]
            ends = _gathered(np.append(ends[0], doc[x[near]]), np.append(ends[1], doc[y[near]]))
        yield pa.record_batch([pa.array(e) for e in ends], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the group that may go on
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = batch if held is None else pa.concat_batches([held, batch])
            last = int(np.flatnonzero(starts_of(whole))[-1])
            yield from pairs_of(whole.slice(0, last))
            held = whole.slice(last)
        if held is not None:
            yield from pairs_of(held)

    return run


def _gathered(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(member, least member) for the members, but the least, of each class of numbers that the pairs (a, b) connect."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right, root = at[: len(a)], at[len(a) :], np.arange(len(ids))
    while True:
        low, lower = np.minimum(root[left], root[right]), root.copy()
        np.minimum.at(lower, root[left], low)
        np.minimum.at(lower, root[right], low)
        while (lower[lower] != lower).any():
            lower = lower[lower]
        if (lower == root).all():
            member = root != np.arange(len(ids))
            return ids[member], ids[root[member]]
        root = lower


def _links_among(docs: DataFrame, near: DataFrame, label: DataFrame, members: DataFrame, least: Fraction, width: int) -> DataFrame:
    """(doc, centre): what the links connect between documents that the pairs ``near`` (doc, centre) connect and ``label`` does not.

    Documents so connected are dealt to blocks of bounded size. Each pair of blocks is a piece of work, to which the sets of both go, and
    which gives back a row a document at most.
    """
    ids = near.select(F.explode(F.array("doc", "centre")).alias("id"))
    connected = components(ids, near.select(F.col("doc").alias("src"), F.col("centre").alias("dst")))
    clumps = cut_lineage(connected.select(F.col("id").alias("doc"), F.col("component").alias("clump")))
    sizes = clumps.join(members.select("doc", "n"), "doc").groupBy("clump")
    most = F.greatest(F.count(F.lit(1)) / BLOCK_DOCS, F.sum("n") / BLOCK_SHINGLES)
    blocks = cut_lineage(sizes.agg((F.floor(most) + 1).alias("blocks")))
    names = label.select(F.col("id").alias("doc"), "component")
    placed = clumps.join(small_side(blocks), "clump").join(names, "doc", "left")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("doc"), F.col("blocks")))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    place = F.struct(
        "clump", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block",
        F.coalesce("component", "doc").alias("component"),
    )
    piece = F.floor(F.col("other") / 1024)  # lists of bounded length
    wanted = cut_lineage(placed.groupBy(F.col("doc").alias("want"), piece.alias("piece")).agg(F.collect_list(place).alias("places")))
    found = id_and_text(docs).join(small_side(wanted), F.col("doc_id") == F.col("want")).select("doc_id", "text", "places")
    kept = ["clump", "lo", "hi", "block", "component"]

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in batches:
            for (doc, data), places in zip(rows(batch), batch.column("places")):
                items = shingler(data or b"").tobytes()
                listed = places.as_py() if items else []
                for at in range(0, len(listed), 100):
                    some = listed[at : at + 100]
                    columns = [*[[p[k] for p in some] for k in kept], [doc] * len(some), [items] * len(some)]
                    yield pa.record_batch(columns, names=[*kept, "doc", "items"])

    order = ["clump", "lo", "hi"]
    shape = ", ".join([*[f"{k} long" for k in kept], "doc long", "items binary"])
    stream = found.mapInArrow(sets, shape).repartition(*order).sortWithinPartitions(*order)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []
        for batch in batches:
            places = zip(*[batch.column(c).to_pylist() for c in [*kept, "doc"]])
            for (*key, block, component, doc), value in zip(places, batch.column("items")):
                if key != at:
                    yield _linked(held, least)
                    at, held = key, []
                # Within one block all are held to each other.
                held.append((block if key[1] != key[2] else len(held), component, doc, np.frombuffer(value.as_py(), dtype=np.uint64)))
        yield _linked(held, least)

    return stream.mapInArrow(link, "doc long, centre long").distinct()


def _linked(held: list[tuple[int, int, int, np.ndarray]], least: Fraction) -> pa.RecordBatch:
    """What the links connect (see ``_gathered``) between (block, component, doc, set) of different blocks and components."""
    num, den = least.numerator, least.denominator
    held = sorted(held, key=lambda h: len(h[3]))
    block, component, doc = (np.array([h[k] for h in held], dtype=np.int64) for k in range(3))
    n = np.array([len(h[3]) for h in held], dtype=np.int64)
    start = np.append(0, np.cumsum(n))
    values, place = np.unique(np.concatenate([np.zeros(0, dtype=np.uint64), *[h[3] for h in held]]), return_inverse=True)
    own, a, b = np.zeros(len(values), dtype=bool), [doc[:0]], [doc[:0]]
    for i, end in enumerate(np.searchsorted(n, n * den // num, side="right").tolist()):
        j = np.arange(i + 1, end)
        some = (component[j] != component[i]) & (block[j] != block[i])
        if not some.any():
            continue
        own[place[start[i] : start[i + 1]]] = True
        common = np.add.reduceat(own[place[start[i + 1] : start[end]]], start[j] - start[i + 1], dtype=np.int64)
        own[place[start[i] : start[i + 1]]] = False
        near = j[some & (common * den >= num * (n[i] + n[j] - common))]
        a.append(np.full(len(near), doc[i]))
        b.append(doc[near])
    ends = _gathered(np.concatenate(a), np.concatenate(b))
    return pa.record_batch([pa.array(e) for e in ends], names=["doc", "centre"])


def keep_one(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """``docs`` with the document of least doc_id of each class of near duplicates; all columns stay.

    Rows without doc_id stay, and so do all rows of a doc_id that stays.
    """
    found = near_components(docs, percent, width)
    drop = cut_lineage(found.where("component_id <> doc_id").select(F.col("doc_id").alias("_drop")).distinct())
    return docs.join(small_side(drop), F.col("doc_id") == F.col("_drop"), "left_anti")
