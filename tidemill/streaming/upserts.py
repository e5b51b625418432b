"""A keyed table that micro-batches upsert into, kept small by merging epochs level by level.

Each batch writes its rows, the newest value of each key, as a segment of level 0, dealt into buckets by key. When a level holds ``fan``
segments they are merged into one segment of the next level, which keeps the newest value of each key, so a table after n batches
is at most ``fan - 1`` segments on each of log(n) levels, and a row is rewritten once for each level. A segment's name tells which
epochs it holds, and ``_SUCCESS`` in it that it is whole, so a reader finds the live segments by listing names: a
segment whose epochs a whole segment of a higher level holds is dead. An epoch that runs again after a failure is either held by
a merged segment, and then skipped, or replaces its own segment. Nothing is changed in place; dead segments are released one
merge later, when no batch that began before can still read them.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_NAME = re.compile(r"level=(\d+)/from=(\d+)-to=(\d+)$")


class UpsertTable:
    """Newest value of each key of ``keys`` in rows of ``schema`` (DDL); ``write`` is a writer for ``foreachBatch``."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], fan: int = 4, buckets: int = 8):
        if fan < 2 or buckets < 1:
            raise ValueError("fan must be 2 or more, buckets 1 or more")
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.fan, self.buckets = list(keys), fan, buckets

    # --- segments ------------------------------------------------------------------------------------

    def _files(self):
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm.org.apache.hadoop.fs.Path, root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _whole(self) -> list[tuple[int, int, int]]:
        """(level, first epoch, last epoch) of the segments that were written to their ends."""
        path, fs = self._files()
        found = fs.globStatus(path(f"{self.path}/level=*/from=*/_SUCCESS")) or []
        names = [_NAME.search(str(f.getPath().getParent().toString())) for f in found]
        return sorted(tuple(map(int, n.groups())) for n in names if n)

    @staticmethod
    def _held(segment: tuple[int, int, int], others: list[tuple[int, int, int]]) -> bool:
        level, first, last = segment
        return any(o > level and a <= first and last <= b for o, a, b in others)

    def segments(self) -> list[tuple[int, int, int]]:
        """The live segments, oldest epochs first."""
        whole = self._whole()
        return sorted((s for s in whole if not self._held(s, whole)), key=lambda s: s[1])

    def _at(self, segment: tuple[int, int, int]) -> str:
        return "{}/level={}/from={}-to={}".format(self.path, *segment)

    # --- writing -------------------------------------------------------------------------------------

    def _put(self, rows: DataFrame, segment: tuple[int, int, int]) -> None:
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        dealt = rows.withColumn("bucket", bucket).repartition(self.buckets, "bucket")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(self._at(segment))

    def write(self, batch: DataFrame, epoch: int) -> None:
        """Upserts a batch with at most one row for each key; the same epoch again changes nothing."""
        if any(level and first <= epoch <= last for level, first, last in self._whole()):
            return
        self._put(batch.withColumn("epoch", F.lit(epoch).cast("long")), (0, epoch, epoch))
        self.compact()

    def compact(self) -> None:
        level = 0
        while True:
            own = [s for s in self.segments() if s[0] == level]
            if len(own) < self.fan:
                return
            merged = (level + 1, own[0][1], own[-1][2])
            self._release(merged)
            self._put(self._newest([self._at(s) for s in own]), merged)
            level += 1

    def _release(self, coming: tuple[int, int, int]) -> None:
        """Deletes segments that were dead before ``coming`` is written, below the table's own folder."""
        path, fs = self._files()
        whole = self._whole()
        for segment in whole:
            if self._held(segment, whole) and segment[0] < coming[0]:
                fs.delete(path(self._at(segment)), True)

    # --- reading -------------------------------------------------------------------------------------

    def _newest(self, places: list[str]) -> DataFrame:
        parts = [self.spark.read.schema(f"{self.schema}, epoch long").parquet(p).drop("bucket") for p in places]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        rest = [c for c in rows.columns if c not in (*self.keys, "epoch")]
        best = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*rest, "epoch"), "epoch").alias("best"))
        return best.select(*self.keys, *[F.col(f"best.{c}").alias(c) for c in (*rest, "epoch")])

    def read(self) -> DataFrame:
        """The table as the last batch left it."""
        live = self.segments()
        return self._newest([self._at(s) for s in live]).drop("epoch") if live else self.spark.createDataFrame([], self.schema)
