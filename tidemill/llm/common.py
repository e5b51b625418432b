"""What the operators of this folder share: shipping code, Arrow rows, vocabularies, blocks of long texts."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the bytes that ``bytes.split()`` splits at.
SPACE = rb"\x20\x09-\x0D"
#: Texts are worked on in blocks of about so many bytes, so that memory does not follow the longest text.
BLOCK = 1 << 20
_CUT = re.compile(rb"[^" + SPACE + rb"](?=[" + SPACE + rb"])")


#: Rows of an Arrow batch where the session has Spark's own setting, which is for rows much smaller than texts.
BATCH_ROWS = 2_500


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of ``BATCH_ROWS`` rows, unless the session has a smaller or an own number."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(BATCH_ROWS))


def vocabulary(spark: SparkSession, path: str) -> Broadcast:
    """The bytes of a vocabulary file (a few MB, whatever the data), read once on the driver."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def id_and_text(docs: DataFrame) -> DataFrame:
    """doc_id as long and text, whatever other columns there are."""
    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def rows(batch: pa.RecordBatch, by_id: bool = False) -> Iterator[tuple[int | None, bytes | None]]:
    """(doc_id, UTF-8 bytes) of each row, with ``by_id`` in the order of doc_id (null last); one text at a time leaves
    Arrow's buffers."""
    ids = batch.column("doc_id").to_pylist()
    texts = batch.column("text").cast(pa.large_binary())
    for i in sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i])) if by_id else range(len(ids)):
        yield ids[i], texts[i].as_py()


def blocks(data: bytes, size: int = BLOCK) -> Iterator[bytes]:
    """``data`` in pieces of about ``size`` bytes, cut between a word and the white space after it only."""
    start = 0
    while len(data) - start > size:
        found = _CUT.search(data, start + size - 1)
        if found is None:
            break
        yield data[start : found.end()]
        start = found.end()
    yield data[start:] if start else data


def capped(cache: dict, most: int) -> dict:
    """``cache``, emptied first if it holds more than ``most`` entries."""
    if len(cache) > most:
        cache.clear()
    return cache


class Generations:
    """A cache of two generations: when the young one is full it becomes the old one, and a hit there moves back to the young one,
    so what is used often stays while what was seen once goes."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def fresh(self, keys: set) -> set:
        """The keys of ``keys`` that are not held; all others are in ``young`` afterwards, where the caller puts these too."""
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}
        missing = keys.difference(self.young)
        for key in missing & self.old.keys():
            self.young[key] = self.old[key]
        return missing.difference(self.young)
