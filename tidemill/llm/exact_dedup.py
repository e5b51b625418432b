"""Exact duplicates by composable polynomial fingerprints, with a chunkwise comparison of what they call equal.

A text's fingerprint is its length and its value as a polynomial in two fixed bases modulo two primes. Fingerprints of
neighbouring chunks combine: the left value is shifted by the right one's length. Long texts are therefore cut
into chunks which are hashed in parallel, by different tasks, and put together afterwards; white space that a cut parts
is counted once. Texts with equal fingerprints are then compared chunk by chunk with the first of their group, as a
sorted stream that holds one chunk at a time, and texts that differ form groups of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, small_side
from .common import id_and_text, rows

#: (prime, base) of the two polynomials.
MODULI = ((2147483647, 1001160001), (2147483629, 1687301087))
BLOCK = 4096
#: Characters of a chunk, and bytes above which a text is hashed by chunks.
CHUNK_CHARS = 1 << 20
HUGE = 4 << 20
#: Bytes that are compared at a time, and members that share one copy of the text they are compared with.
COMPARE = 1 << 16
MEMBERS = 256
PRINTS = "doc_id long, n_bytes long, h1 long, h2 long, sha binary"
#: White space that counts as one space, as a class for the JVM.
SPACES = "[ \\t-\\r]+"


def _powers(prime: int, base: int) -> np.ndarray:
    out, value = [], 1
    for _ in range(BLOCK):
        out.append(value)
        value = value * base % prime
    return np.array(out[::-1], dtype=np.float64)


_POWERS = [_powers(*m) for m in MODULI]


def normalise(data: bytes) -> bytes:
    """Every run of ASCII white space as one space, also at the ends."""
    words = data.split()
    if not words:
        return b" " if data else b""
    inner = b" ".join(words)
    return (b" " if data[0] in b" \t\n\v\f\r" else b"") + inner + (b" " if data[-1] in b" \t\n\v\f\r" else b"")


class Print(NamedTuple):
    """Fingerprint of a normalised text: bytes, the two values, and whether it begins and ends with a space."""

    n: int
    h1: int
    h2: int
    first: bool
    last: bool


def fingerprint(text: bytes) -> Print:
    """Of a text that is normalised already. Block sums stay below 2**53, so they are exact in doubles."""
    values = [0, 0]
    array = np.frombuffer(text, dtype=np.uint8)
    for start in range(0, len(array), BLOCK):
        part = array[start : start + BLOCK].astype(np.float64)
        for k, (prime, base) in enumerate(MODULI):
            own = int(part @ _POWERS[k][BLOCK - len(part) :])
            values[k] = (values[k] * pow(base, len(part), prime) + own) % prime
    return Print(len(text), *values, text[:1] == b" ", text[-1:] == b" ")


def combine(a: Print, b: Print) -> Print:
    """Fingerprint of the two texts one after the other; a space on both sides of the cut is one space."""
    if not a.n or not b.n:
        return b if not a.n else a
    n, values = b.n, [b.h1, b.h2]
    if a.last and b.first:
        n -= 1
        values = [(v - 32 * pow(base, n, prime)) % prime for v, (prime, base) in zip(values, MODULI)]
    joined = [(v * pow(base, n, prime) + w) % prime for v, w, (prime, base) in zip((a.h1, a.h2), values, MODULI)]
    return Print(a.n + n, *joined, a.first, b.last)


def _batch(out: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "int": pa.int32()}
    fields = [c.split() for c in schema.split(", ")]
    columns = list(zip(*out)) if out else [[]] * len(fields)
    return pa.record_batch([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc_id, data in rows(batch):
            text = normalise(data or b"")
            p = fingerprint(text)
            out.append((doc_id, p.n, p.h1, p.h2, hashlib.sha256(text).digest()))
        yield _batch(out, PRINTS)


def _by_chunks(huge: DataFrame, chunk_chars: int) -> DataFrame:
    """Fingerprints of long texts, whose chunks are dealt out over the cluster. sha256 needs the text in order and
    is taken where the text is."""
    named = huge.withColumn("row", F.monotonically_increasing_id())
    count = F.greatest(F.ceil(F.char_length("text") / F.lit(chunk_chars)), F.lit(1)).cast("int")
    cuts = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.substring("text", i * chunk_chars + 1, F.lit(chunk_chars)))
    sha = F.unhex(F.sha2(F.regexp_replace("text", SPACES, " "), 256))
    chunks = named.select("row", "doc_id", sha.alias("sha"), cuts.alias("cuts")).select(
        "row", "doc_id", "sha", F.posexplode("cuts").alias("at", "text")
    )

    def hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(normalise(v.as_py())) for v in batch.column("text").cast(pa.large_binary())]
            own = _batch([tuple(p) for p in prints], "n long, h1 long, h2 long, first boolean, last boolean")
            kept = [batch.column(c) for c in ("row", "doc_id", "at", "sha")]
            yield pa.record_batch([*kept, *own.columns], names=["row", "doc_id", "at", "sha", *own.schema.names])

    schema = "row long, doc_id long, at int, sha binary, n long, h1 long, h2 long, first boolean, last boolean"
    dealt = chunks.repartition("row", "at").mapInArrow(hash_chunks, schema)
    parts = F.sort_array(F.collect_list(F.struct("at", "n", "h1", "h2", "first", "last")))
    listed = dealt.groupBy("row", "doc_id", "sha").agg(parts.alias("parts"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                whole = Print(0, 0, 0, False, False)
                for p in r["parts"]:
                    whole = combine(whole, Print(p["n"], p["h1"], p["h2"], p["first"], p["last"]))
                out.append((r["doc_id"], whole.n, whole.h1, whole.h2, r["sha"]))
            yield _batch(out, PRINTS)

    return listed.mapInArrow(fold, PRINTS)


def fingerprints(docs: DataFrame, huge: int = HUGE, chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """doc_id, n_bytes, h1, h2 and sha (sha256) of every row's normalised text."""
    texts = id_and_text(docs).withColumn("text", F.coalesce("text", F.lit("")))
    size = F.octet_length("text")
    return texts.where(size <= huge).mapInArrow(_whole, PRINTS).unionByName(_by_chunks(texts.where(size > huge), chunk_chars))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def _differing(docs: DataFrame, grouped: DataFrame) -> DataFrame:
    """(doc_id, sha) of the rows in ``grouped`` (doc_id, sha, n_bytes, h1, h2, keep_id, keep_sha, size) whose text is not
    that of the row they were put with."""
    several = grouped.where("size > 1")
    copies = F.explode(F.sequence(F.lit(0), F.floor(F.col("size") / MEMBERS))).alias("salt")
    keepers = (
        several.where(_same("doc_id", "keep_id") & (F.col("sha") == F.col("keep_sha")))
        .dropDuplicates(["doc_id", "sha"])
        .select("doc_id", "sha", "keep_id", "keep_sha", F.lit(True).alias("first"), "size", copies)
        .drop("size")
    )
    members = several.select(
        "doc_id", "sha", "keep_id", "keep_sha", F.lit(False).alias("first"),
        F.pmod(F.xxhash64("doc_id", "sha"), F.floor(F.col("size") / MEMBERS) + 1).alias("salt"),
    ).where(~(_same("doc_id", "keep_id") & (F.col("sha") == F.col("keep_sha"))))
    wanted = members.unionByName(keepers).withColumnRenamed("doc_id", "want_id")
    wanted = small_side(cut_lineage(wanted))
    texts = id_and_text(docs).withColumn("text", F.coalesce("text", F.lit("")))
    found = texts.join(wanted, _same("doc_id", "want_id")).drop("want_id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "sha", "keep_id", "keep_sha", "first", "salt"]
        for batch in batches:
            plain = zip(*[batch.column(n).to_pylist() for n in names])
            for own, value in zip(plain, batch.column("text").cast(pa.large_binary())):
                text = normalise(value.as_py())
                if hashlib.sha256(text).digest() != own[1]:
                    continue  # another row of the same doc_id
                out = [(*own, at, text[at : at + COMPARE]) for at in range(0, max(len(text), 1), COMPARE)]
                yield _batch(out, CUT)

    CUT = "doc_id long, sha binary, keep_id long, keep_sha binary, first boolean, salt long, at long, chunk binary"
    found = found.withColumn("salt", F.col("salt").cast("long"))
    order = ["keep_sha", "keep_id", "salt", "at"]
    stream = found.mapInArrow(cut, CUT).repartition(*order).sortWithinPartitions(*order, F.desc("first"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, chunk = None, b""
        for batch in batches:
            out = []
            columns = [batch.column(n) for n in ("keep_sha", "keep_id", "salt", "at", "first", "doc_id", "sha", "chunk")]
            for i in range(batch.num_rows):
                *here, first, doc_id, sha, own = [c[i].as_py() for c in columns]
                if first:
                    place, chunk = here, own
                elif here != place or own != chunk:
                    out.append((doc_id, sha))
            yield _batch(out, "doc_id long, sha binary")

    return stream.mapInArrow(compare, "doc_id long, sha binary").distinct()


def exact_dedup(docs: DataFrame, huge: int = HUGE, chunk_chars: int = CHUNK_CHARS, weak_bits: int | None = None) -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are identical once every run of ASCII white space is one space; a null text counts as empty. The
    row with the smallest doc_id of a group stays (``kept``); a null doc_id comes after all others. Rows that repeat
    both doc_id and text are copies: one of them stays. Rows that repeat a doc_id with other texts are texts of their own.
    An empty table gives no rows. Other columns are ignored.

    ``weak_bits`` cuts the fingerprints to so many bits, for tests of what happens when different texts share one.
    """
    prints = fingerprints(docs, huge, chunk_chars)
    if weak_bits is not None:
        prints = prints.withColumns({"h1": F.col("h1") % 2**weak_bits, "h2": F.lit(0).cast("long"), "n_bytes": F.lit(0).cast("long")})
    left = cut_lineage(prints.withColumn("row", F.monotonically_increasing_id()))
    key, done = ["n_bytes", "h1", "h2"], []
    while True:
        first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "sha"))
        groups = left.groupBy(*key).agg(first.alias("keep"), F.count(F.lit(1)).alias("size"))
        several = groups.where("size > 1").select(*[F.col(k).alias(f"_{k}") for k in key], "keep", "size")
        several = small_side(cut_lineage(several))
        on = (F.col("n_bytes") == F.col("_n_bytes")) & (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))
        own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "sha")
        grouped = left.join(several, on, "left").select(
            *left.columns, F.coalesce("keep", own).alias("keep"), F.coalesce("size", F.lit(1)).alias("size")
        )
        grouped = grouped.select(
            *left.columns, F.col("keep.doc_id").alias("keep_id"), F.col("keep.sha").alias("keep_sha"),
            F.col("keep.row").alias("keep_row"), "size",
        )
        other = cut_lineage(_differing(docs, grouped))
        if other.isEmpty():
            done.append(grouped)
            break
        other = other.select(F.col("doc_id").alias("_id"), F.col("sha").alias("_sha"))
        differs = _same("doc_id", "_id") & (F.col("sha") == F.col("_sha"))
        equal = cut_lineage(grouped.join(other, differs, "left_anti"))
        sizes = equal.groupBy("keep_row").agg(F.count(F.lit(1)).alias("size"))
        done.append(equal.drop("size").join(sizes, "keep_row"))
        left = cut_lineage(left.join(other, differs, "left_semi"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(
        "doc_id",
        "keep_id",
        F.col("size").alias("group_size"),
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``exact_dedup`` does not keep; all columns stay.

    Where doc_ids are unique, that is decided by doc_id alone. Else rows are told apart by doc_id and text, and of rows
    that are the same in both one stays.
    """
    decided = cut_lineage(exact_dedup(docs))
    counts = decided.agg(
        F.count(F.lit(1)).alias("n"), F.count("doc_id").alias("filled"), F.countDistinct("doc_id").alias("ids")
    ).first()
    if counts.n == counts.filled == counts.ids:
        drop = decided.where("not kept").select(F.col("doc_id").alias("_drop"))
        return docs.join(small_side(drop), F.col("doc_id") == F.col("_drop"), "left_anti")
    keep = decided.where("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_of"))
    sha = F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), SPACES, " "), 256)
    named = docs.withColumn("_sha", sha)
    found = named.join(keep, _same("doc_id", "_id") & (F.col("_sha") == F.col("_of")), "left_semi")
    return found.dropDuplicates(["doc_id", "_sha"]).drop("_sha")
