"""Repeated passages by content-defined chunks.

A gear hash rolls over the bytes of a text: each byte shifts the hash and adds a fixed random value, and the last ``WINDOW`` bytes
count. A chunk ends where the hash's top bits are zero, and where no hash of ``across`` that follow each other is so, at the least of
them. A cut thus depends on the bytes near it alone, and an insertion moves no cut far from it. As a chunk ends in every ``across``
hashes, any two texts that share ``min_bytes`` bytes share a whole chunk there.

Chunks are told apart by a 64-bit digest and compared in a sorted stream. A chunk is a repeat if a document of smaller doc_id, its
holder, has its digest. Repeats that follow each other in both texts make a segment. The bytes around a segment and around its place
in the holder are then compared, which gives where the passage that both share begins and ends; passages of ``min_bytes`` or more
are kept. So no short phrase counts, no passage is put together from several documents, and no digest is believed beyond its chunk.

Repeats within one Arrow batch are known beforehand and have their holder there. They do not go to the digest's task, so a passage
that a third of all documents share adds one row for each batch there, and its holders are as many as the batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import id_and_text

WINDOW = 16
#: One byte in 2**CUT_BITS ends a chunk.
CUT_BITS = 5
#: Bytes of a chunk at the most.
MOST_BYTES = 128
#: Bytes of a repeated passage at the least, which any passage of over 50 words has.
MIN_BYTES = 96
#: Bytes compared on either side of a segment. Up to its first cut and from its last one on a passage has 56 bytes at the most, and
#: fewer than ``MIN_BYTES`` more where chunks in it have another holder that does not share a passage.
AROUND = 160
#: Chunks that are compared within a worker at a time.
HELD = 400_000
#: The value that each byte adds, from one rule.
GEAR = np.array([xxhash.xxh3_64_intdigest(bytes([b]), seed=97) for b in range(256)], dtype=np.uint64)
_ODD = np.uint64(xxhash.xxh3_64_intdigest(b"side", seed=99) | 1)
#: Bits that a byte shifts the hash by; 19 bits of the oldest one are left.
SHIFT = 3


def _every(h: np.ndarray, size: int, of=np.minimum) -> np.ndarray:
    """The least (by ``of``) of every ``size`` values that follow each other."""
    width = 1
    while 2 * width <= size:
        h = of(h[:-width], h[width:])
        width *= 2
    return of(h[: len(h) - (size - width)], h[size - width :]) if size > width else h


def cuts(data: bytes, min_bytes: int = MIN_BYTES) -> np.ndarray:
    """Ends of the chunks of ``data``, the last one included."""
    ends, n = _cuts(data, min_bytes)[0], len(data)
    return ends if not n or len(ends) and ends[-1] == n else np.append(ends, n)


def _cuts(data: bytes, min_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cuts, which of them hang on the last ``WINDOW`` bytes alone, and the hash of every ``WINDOW`` bytes."""
    across = (min_bytes - WINDOW + 1) // 2
    if len(data) < WINDOW + across - 1:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool), GEAR[:0]
    h = GEAR[np.frombuffer(data, dtype=np.uint8)]
    width = 1
    while width < WINDOW:  # the sum over 2 * width bytes from two sums over width bytes
        h = h[width:] + (h[:-width] << np.uint64(SHIFT * width))
        width *= 2
    low = h <= np.uint64((1 << 64 - CUT_BITS) - 1)
    border = np.zeros(across - 1, dtype=np.uint64)  # windows beyond either end count for nothing
    least = np.concatenate([border, _every(h, across), border])
    at = np.flatnonzero(low | (_every(least, across, np.maximum) == h))
    kept = _thinned(at, h[at], across)
    return kept + WINDOW, low[kept] & (len(kept) == len(at)), h


def _reach(ends: np.ndarray, sure: np.ndarray, n: int, min_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """How far a passage can go on before and after each chunk if the chunk on that side is no repeat."""
    across = (min_bytes - WINDOW + 1) // 2
    size = np.diff(ends)
    before = np.append(ends[0], np.where(sure[:-2], size[:-1] + WINDOW - 1, MOST_BYTES))
    after = np.append(np.where(sure[2:], size[1:] - 1, MOST_BYTES), n - ends[-1])
    return np.minimum(before, WINDOW + across - 1), np.minimum(after, across - 1)


def _sides(ends: np.ndarray, h: np.ndarray, min_bytes: int) -> np.ndarray:
    """Two small hashes (0: the text ends there) of the bytes before and after each chunk. As a chunk has no more than ``across`` bytes, a
    passage has half of the others, so many, on one side of it at least."""
    across = (min_bytes - WINDOW + 1) // 2
    some = (min_bytes - across) // 2

    def small(end: np.ndarray) -> np.ndarray:
        """Of the ``some`` bytes (``WINDOW`` to twice as many) up to ``end``."""
        inside = (end >= some) & (end - WINDOW < len(h))
        at = np.where(inside, end, some if len(h) > some - WINDOW else WINDOW) - WINDOW
        x = h[at] * _ODD + h[np.maximum(at - (some - WINDOW), 0)]
        return np.where(inside, 1 + ((x ^ (x >> np.uint64(29))) * _ODD >> np.uint64(40)).astype(np.int64) % 255, 0)

    return (small(ends[:-1]) << 8) | small(ends[1:] + some)


def _beside(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether the bytes before or those after are alike, going by the hashes of ``_sides``."""
    alike = a ^ b
    return ((alike >> 8 == 0) & (a >> 8 != 0)) | ((alike & 255 == 0) & (a & 255 != 0))


def _thinned(at: np.ndarray, h: np.ndarray, across: int) -> np.ndarray:
    """``at`` without most of the cuts in texts that repeat a word or a phrase: where each cut has the hash of the one ``k`` before it, at
    one distance, the first and the last round of ``k`` stay, and others at most ``across`` bytes apart."""
    for k in (1, 2, 3):
        if len(at) <= k + 1:
            break
        index, border = np.arange(len(at)), np.zeros(k, dtype=bool)
        gap = at[k:] - at[:-k]
        goes_on = np.append(border, (h[k:] == h[:-k]) & (gap <= across))
        goes_on[k + 1 :] &= ~goes_on[k:-1] | (gap[1:] == gap[:-1])
        first = np.maximum.accumulate(np.where(goes_on, 0, index))  # the last one of the first round
        step = np.maximum(1, across // gap[np.clip(first + 1 - k, 0, len(gap) - 1)])
        keep = (index - first + k - 1) // k % step == 0
        for j in range(1, k + 1):
            keep |= np.append(~goes_on[j:], np.ones(j, dtype=bool))
        at, h = at[keep], h[keep]
    return at.astype(np.int64)


#: ``place`` is a chunk's start, its reach before and after, and its length in one number that sorts as the start; its lowest bit tells
#: that the holder is known. Where it is not, ``holder`` has the hashes of the sides. A ``holder_start`` of -1 tells that some document
#: holds the chunk, but no passage around it.
CHUNKS = "digest long, doc long, version long, place long, holder long, holder_version long, holder_start long"
REPEATS = "doc long, version long, start long, length long, holder long, holder_version long, holder_start long, before long, after long"
_REPEATS = [c.split()[0] for c in REPEATS.split(", ")]
_START = 22


def _place(ends: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return (ends[:-1] << _START) | (before << 15) | (after << 8) | ((np.diff(ends) - 1) << 1)


def _holders(digest: np.ndarray, *of: np.ndarray, head: tuple | None = None) -> list[np.ndarray]:
    """For rows (digest, doc, version, start, sides) in this order: doc and version of the digest's first row, the first, the middle and the
    last place of the digest there, and their sides. ``head`` has these for rows that go on with the digest of a batch before."""
    doc, version, start, sides = of
    n = len(digest)
    new = np.append(head is None, digest[1:] != digest[:-1])
    first = np.maximum.accumulate(np.where(new, np.arange(n), -1))
    begin = np.maximum(first, 0)
    group = np.cumsum(new)
    places = np.bincount(group, (doc == doc[begin]) & (version == version[begin])).astype(np.int64)[group]
    at = [begin, begin + (places - 1) // 2, begin + places - 1]
    found = [doc[begin], version[begin], *(start[i] for i in at), *(sides[i] for i in at)]
    return found if head is None else [np.where(first < 0, h, x) for h, x in zip(head, found)]


def _with_known(digest: np.ndarray, doc: np.ndarray, version: np.ndarray, place: np.ndarray, sides: np.ndarray) -> pa.RecordBatch:
    """Rows (in the order of doc, version and place) of a batch; those whose digest a document before theirs has in this batch, with its
    first one there as holder, once for each place that ``_holders`` gives."""
    order = np.argsort(digest, kind="stable")
    found = _holders(digest[order], doc[order], version[order], place[order] >> _START, sides[order])
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    holder, holder_version, *places = (x[back] for x in found)
    known = doc != holder
    zero = np.zeros_like(doc)
    out = [[x[~known] for x in (digest, doc, version, place, sides, zero, zero)]]
    for start, pick in _apart(places, known, sides):
        out.append([x[pick] for x in (digest, doc, version, place | 1, holder, holder_version, start)])
    return pa.record_batch([pa.array(np.concatenate(x)) for x in zip(*out)], names=[c.split()[0] for c in CHUNKS.split(", ")])


def _apart(places: list[np.ndarray], rows: np.ndarray, sides: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The first, the middle and the last start of ``places`` with those of ``rows`` to be compared there; the first, or -1, with all."""
    starts, beside = places[:3], [_beside(sides, x) for x in places[3:]]
    yield np.where(beside[0], starts[0], -1), rows
    for k in (1, 2):
        yield starts[k], rows & beside[k] & (starts[k] != starts[k - 1])


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, int, bytes]]:
    """(doc, version, bytes) of each row, one text at a time."""
    text = batch.column("text").cast(pa.large_binary())
    for i, (doc, version) in enumerate(zip(batch.column("doc").to_pylist(), batch.column("version").to_pylist())):
        yield doc, version, text[i].as_py()


def _chunks(min_bytes: int):
    def flush(digest: list, texts: list, place: list, sides: list) -> pa.RecordBatch:
        sizes = [len(x) for x in place]
        docs, versions = (np.repeat(np.array([t[k] for t in texts], dtype=np.int64), sizes) for k in (0, 1))
        return _with_known(np.frombuffer(b"".join(digest), dtype=">i8").astype(np.int64), docs, versions, np.concatenate(place), np.concatenate(sides))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest_of = xxhash.xxh3_64_digest
        for batch in batches:
            held, kept = 0, ([], [], [], [])
            for doc, version, data in _texts(batch.sort_by([("doc", "ascending"), ("version", "ascending")])):
                ends, sure, h = _cuts(data, min_bytes)
                if len(ends) < 2:  # what is before the first cut and after the last one is no chunk of a passage
                    continue
                kept[0].extend([digest_of(data[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())])
                kept[1].append((doc, version))
                kept[3].append(_sides(ends, h, min_bytes))
                kept[2].append(_place(ends, *_reach(ends, sure, len(data), min_bytes)))
                held += len(ends) - 1
                if held > HELD:
                    yield flush(*kept)
                    held, kept = 0, ([], [], [], [])
            if held:
                yield flush(*kept)

    return run


def _repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (digest, doc, version, place): those with a holder, once for each place that ``_holders`` gives."""
    last, head = None, None  # digest of the row before, and its holder
    for batch in batches:
        if not batch.num_rows:
            continue
        digest, doc, version, place, *holder = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        known = place & 1 == 1
        out = [[x[known] for x in (doc, version, place, *holder)]]
        if not known.all():  # known rows are dealt out apart from their digest, so only the others make groups
            digest, doc, version, place, sides = (x[~known] for x in (digest, doc, version, place, holder[0]))
            goes_on = last is not None and digest[0] == last
            found = _holders(digest, doc, version, place >> _START, sides, head=head if goes_on else None)
            holder, holder_version, *places = found
            out += [[x[pick] for x in (doc, version, place, holder, holder_version, at)] for at, pick in _apart(places, doc != holder, sides)]
            last, head = digest[-1], tuple(x[-1] for x in found)
        doc, version, place, *holder = (np.concatenate(x) for x in zip(*out))
        values = [doc, version, place >> _START, ((place >> 1) & 127) + 1, *holder, (place >> 15) & 127, (place >> 8) & 127]
        yield pa.record_batch([pa.array(x) for x in values], names=_REPEATS)


def _long_runs(min_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From repeats sorted by (doc, version, start): those in runs that, with their reach, may belong to a passage. Within a run the
        bytes to compare are ``AROUND``, as other holders may follow."""
        short = None  # rows of the last run while it is too short
        tail = None  # doc, version and end of the last run, if it is long enough
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in _REPEATS]
            if short is not None:
                columns = [np.append(a, b) for a, b in zip(short, columns)]
            doc, version, start, length, before, after = (columns[i] for i in (0, 1, 2, 3, 7, 8))
            other = np.append(False, (doc[1:] != doc[:-1]) | (version[1:] != version[:-1]))
            text = np.cumsum(other) << 44
            end = np.maximum.accumulate(text + start + length) - text
            new = other | np.append(True, start[1:] > end[:-1])
            begins, of = np.flatnonzero(new), np.cumsum(new) - 1
            ends = np.append(begins[1:], len(doc)) - 1
            first, last = start[begins], end[ends]
            goes_on = tail is not None and tail[:2] == (doc[0], version[0]) and start[0] <= tail[2]
            whole = last - first + before[begins] + after[ends] >= min_bytes
            whole[0] |= goes_on
            edge = start == first[of]
            edge[of == 0] &= not goes_on
            before, after = np.where(edge, before, AROUND), np.where(start + length == last[of], after, AROUND)
            keep = whole[of] & (columns[6] >= 0)
            after[of == len(begins) - 1] = AROUND  # the run may go on
            open_ = [c[begins[-1] :] for c in columns]
            short = None if whole[-1] else open_
            tail = (doc[-1], version[-1], end[-1]) if whole[-1] else None
            values = [*columns[:7], -(-before // 16) * 16, -(-after // 16) * 16]
            yield pa.record_batch([pa.array(v[keep]) for v in values], names=_REPEATS)

    return run


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From repeats sorted by (doc, version, holder, holder_version, start - holder_start, start): those that follow each other in both
    texts, as one."""
    open_ = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in _REPEATS]
        if open_ is not None:
            columns = [np.append(a, b) for a, b in zip(open_, columns)]
        doc, version, start, length, holder, holder_version, holder_start = columns[:7]
        same = [x[1:] == x[:-1] for x in (doc, version, holder, holder_version, start - holder_start)]
        new = np.append(True, ~np.logical_and.reduce(same) | (start[1:] > (start + length)[:-1]))
        begins = np.flatnonzero(new)
        ends = np.append(begins[1:], len(doc)) - 1
        after = columns[8][ends]
        columns = [c[begins] for c in columns]
        columns[3], columns[8] = (start + length)[ends] - columns[2], after
        open_ = [c[-1:] for c in columns]
        yield pa.record_batch([pa.array(c[:-1]) for c in columns], names=_REPEATS)
    if open_ is not None:
        yield pa.record_batch([pa.array(c) for c in open_], names=_REPEATS)


_KEY = ["holder", "holder_version", "holder_start", "length", "before", "after"]
AROUNDS = "".join(f"{k} long, " for k in _KEY) + "own boolean, doc long, version long, start long, left binary, right binary"


def _around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From texts with the segments asked of them: as many bytes before (backwards) and after each as the segment needs, zeros where
    the text ends, and in front the number of bytes that are none of these."""
    reach = np.arange(AROUND)

    def cells(inside: np.ndarray, need: np.ndarray, found: np.ndarray) -> pa.Array:
        full = np.hstack([np.minimum(inside, need)[:, None].astype(np.uint8), found])
        use = np.append(-1, reach) < need[:, None]
        offsets = np.append(0, np.cumsum(need + 1)).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(full), [None, pa.py_buffer(offsets), pa.py_buffer(full[use].tobytes())])

    for batch in batches:
        asked = batch.column("asked")
        for i, (doc, version, data) in enumerate(_texts(batch)):
            of = asked[i].values.flatten()
            names = [f.name for f in asked.type.value_type]
            parts = {n: c.to_numpy(zero_copy_only=False) for n, c in zip(names, of)}
            padded = np.concatenate([np.zeros(AROUND, np.uint8), np.frombuffer(data, np.uint8), np.zeros(AROUND, np.uint8)])
            for at in range(0, len(parts["start"]), 8_192):
                p = {n: c[at : at + 8_192] for n, c in parts.items()}
                begin, end = p["at"], p["at"] + p["length"]
                left = cells(begin, p["before"], padded[begin[:, None] + (AROUND - 1) - reach])
                right = cells(len(data) - end, p["after"], padded[end[:, None] + AROUND + reach])
                n = len(begin)
                values = [*(p[k] for k in _KEY), p["own"], np.full(n, doc), np.full(n, version), p["start"]]
                yield pa.record_batch([*(pa.array(v) for v in values), left, right], names=[c.split()[0] for c in AROUNDS.split(", ")])


def _bytes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(x.ljust(AROUND + 1, b"\0") for x in column.to_pylist()), dtype=np.uint8).reshape(len(column), AROUND + 1)


def _alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many bytes are the same at the start of each pair of rows."""
    other = a[:, 1:] != b[:, 1:]
    same = np.where(other.any(axis=1), other.argmax(axis=1), AROUND)
    return np.minimum(same, np.minimum(a[:, 0], b[:, 0])).astype(np.int64)


SPANS = "doc_id long, version long, start long, length long"
_SPANS = ["doc_id", "version", "start", "length"]


def _passages(min_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """From rows sorted by (key, own), the holder's row first: passages."""
        held = None  # key and bytes of the last holder's row
        for batch in batches:
            if not batch.num_rows:
                continue
            own, doc, version, start, length = (
                batch.column(n).to_numpy(zero_copy_only=False) for n in ("own", "doc", "version", "start", "length")
            )
            before, after = _bytes(batch.column("left")), _bytes(batch.column("right"))
            at = np.maximum.accumulate(np.where(own, -1, np.arange(len(own))))
            if held is None:
                held = before[0], after[0]
            left, right = (np.where((at < 0)[:, None], h, x[np.maximum(at, 0)]) for h, x in zip(held, (before, after)))
            held = left[-1].copy(), right[-1].copy()
            more = _alike(before, left)
            whole = more + length + _alike(after, right)
            found = own & (whole >= min_bytes)
            values = [x[found] for x in (doc, version, start - more, whole)]
            yield pa.record_batch([pa.array(v) for v in values], names=_SPANS)

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From passages sorted by (doc_id, version, start): those that overlap or touch, as one."""
    open_ = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in _SPANS]
        if open_ is not None:
            columns = [np.append(a, b) for a, b in zip(open_, columns)]
        doc, version, start, length = columns
        other = np.append(False, (doc[1:] != doc[:-1]) | (version[1:] != version[:-1]))
        text = np.cumsum(other) << 44  # ends go up within a text
        end = np.maximum.accumulate(text + start + length) - text
        begins = np.flatnonzero(other | np.append(True, start[1:] > end[:-1]))
        ends = np.append(begins[1:], len(doc)) - 1
        columns = [doc[begins], version[begins], start[begins], end[ends] - start[begins]]
        open_ = [c[-1:] for c in columns]
        yield pa.record_batch([pa.array(c[:-1]) for c in columns], names=_SPANS)
    if open_ is not None:
        yield pa.record_batch([pa.array(c) for c in open_], names=_SPANS)


def _version(text: Column) -> Column:
    """Tells apart the texts of rows that repeat a doc_id."""
    return F.shiftrightunsigned(F.xxhash64(text), 33)


def whole_passages(docs: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """doc_id, version, start and length (in bytes of UTF-8) of the passages of ``min_bytes`` bytes (64 to 128) or more that a document
    of smaller doc_id holds, from their first byte to their last.

    What repeats within one document alone is no repeated passage; neither is what rows that repeat a doc_id share, and
    ``version`` tells their texts apart. Null and empty texts, and rows without doc_id, hold no passages. An empty table
    gives no rows. Other columns are ignored. Passages that overlap or touch come as one.

    A passage is followed as far as it agrees with the first holder of one of its chunks. Bytes at an end that only a later holder shares
    are not found, and a short passage is missed where each of its chunks is first held by a document that does not share it.
    """
    if not 64 <= min_bytes <= 128:
        raise ValueError("min_bytes: 64 to 128")
    texts = id_and_text(docs).select(F.col("doc_id").alias("doc"), _version(F.col("text")).alias("version"), "text")
    texts = texts.where("doc is not null and text is not null")
    alone = F.when(F.col("place") % 2 == 1, F.xxhash64("doc", "place")).otherwise(F.col("digest"))
    chunks = texts.where(F.octet_length("text") >= min_bytes).mapInArrow(_chunks(min_bytes), CHUNKS)
    repeats = chunks.repartition(alone).sortWithinPartitions("digest", "doc", "version", "place").mapInArrow(_repeats, REPEATS)
    diagonal = F.col("start") - F.col("holder_start")
    in_runs = repeats.repartition("doc").sortWithinPartitions("doc", "version", "start", "length").mapInArrow(_long_runs(min_bytes), REPEATS)
    in_line = in_runs.sortWithinPartitions("doc", "version", "holder", "holder_version", diagonal, "start")
    segments = cut_lineage(in_line.mapInArrow(_joined, REPEATS))
    key = [F.col(c) for c in _KEY]  # it has the bytes needed, so that a holder's row has as many as its repeats'
    asks = segments.select(
        "doc", "version", F.struct(*key, F.lit(True).alias("own"), "start", F.col("start").alias("at")).alias("ask")
    ).unionByName(
        segments.select(
            F.col("holder").alias("doc"), F.col("holder_version").alias("version"),
            F.struct(*key, F.lit(False).alias("own"), F.lit(0).cast("long").alias("start"), F.col("holder_start").alias("at")).alias("ask"),
        )
    )
    asked = asks.groupBy("doc", "version").agg(F.collect_set("ask").alias("asked"))
    around = texts.join(asked.hint("merge"), ["doc", "version"]).mapInArrow(_around, AROUNDS)
    dealt = around.repartition(*_KEY).sortWithinPartitions(*_KEY, "own")
    found = dealt.mapInArrow(_passages(min_bytes), SPANS)
    return found.repartition("doc_id").sortWithinPartitions("doc_id", "version", "start").mapInArrow(_merged, SPANS)


def without_repeats(docs: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``; ``n_chars``, if there, follows the text of changed rows.

    Every row and all other columns stay, also where nothing of a text is left. The first occurrence of a passage stays. Passages
    are those of ``whole_passages``, drawn in to whole characters.
    """
    spans = whole_passages(docs, min_bytes)
    listed = cut_lineage(
        spans.groupBy(F.col("doc_id").alias("_id"), F.col("version").alias("_version")).agg(
            F.sort_array(F.collect_list(F.struct("start", "length"))).alias("_cut")
        )
    )
    same = (F.col("doc_id").cast("long") == F.col("_id")) & (_version(F.col("text").cast("string")) == F.col("_version"))
    found = docs.join(listed.hint("merge"), same, "left").drop("_id", "_version")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value, spans in zip(batch.column("text").cast(pa.large_binary()), batch.column("_cut")):
                out.append(_cut(value.as_py(), spans.as_py()))
            text = pa.array(out, pa.large_binary()).cast(pa.large_string()).cast(batch.schema.field("text").type)
            keep = [text if n == "text" else batch.column(n) for n in batch.schema.names]
            yield pa.record_batch(keep, names=batch.schema.names).drop_columns(["_cut"])

    schema = docs.withColumn("text", F.col("text").cast("string")).schema
    changed = found.where("_cut is not null").withColumn("text", F.col("text").cast("string")).mapInArrow(cut, schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = changed.withColumn("n_chars", F.char_length("text").cast(kind))
    return found.where("_cut is null").drop("_cut").unionByName(changed)


def _cut(data: bytes, spans: list[dict]) -> bytes:
    """``data`` without its spans, each drawn in to whole characters."""
    out, at = [], 0
    for s in spans:
        a, b = s["start"], s["start"] + s["length"]
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while b < len(data) and b > a and data[b] & 0xC0 == 0x80:
            b -= 1
        out.append(data[at:a])
        at = b
    out.append(data[at:])
    return b"".join(out)
