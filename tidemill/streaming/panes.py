"""Counts over panes with own state and timers: sliding windows with an inverse step, and totals with a snapshot each pane.

A pane is a stretch of event time as long as the slide. State keeps, for each key, the counts of the panes that are not yet closed or
still inside the window, and the window's current sum. A row adds one to one pane, however many windows overlap. When the watermark
has passed a pane's end the key's timer fires: the new pane's count is added to the sum, the count of the pane that has left the window
is taken off, and the sum goes out. A key whose panes are all gone holds no state. Nothing is rewritten: each closed window is one row.

Hot keys are split by a salt that is part of the key; ``summed`` adds the parts up. Keys are dealt to buckets, which are the keys of the state
store: a bucket's keys are read, written and timed together, so a call to the store serves many keys.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..session import shuffle_width

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
WIDTH = "spark.sql.shuffle.partitions"
#: Keys of a bucket one after another: key parts, then what ``Panes`` holds, with the number of panes of each key.
STATE = "closed array<long>, sums array<long>, held array<long>, starts array<long>, counts array<long>"
#: Buckets of keys. They are written into checkpoints, so they do not follow the input.
BUCKETS = 256
#: Rows to a state partition, the least number of these, and windows to a frame that goes out.
STATE_ROWS, STATE_PARTS, FRAME_ROWS = 500_000, 8, 100_000


def state_parts(spark: SparkSession, rows: int) -> int:
    """State partitions for a stream of ``rows`` rows. Each opens a store and a worker in every batch, so few rows get few, and no
    stream gets more than the session's shuffles have."""
    return min(shuffle_width(spark), max(STATE_PARTS, -(-rows // STATE_ROWS)))


@contextmanager
def keyed_state(spark: SparkSession, parts: int | None = None) -> Iterator[None]:
    """The state store that timers need, in ``parts`` partitions if given, for queries that run inside; the session's settings come back
    afterwards."""
    wanted = {PROVIDER: ROCKSDB} | ({} if parts is None else {WIDTH: str(parts)})
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


class Panes:
    """State of one key: counts of panes by start, the window's sum, and the end of the last pane that was closed."""

    def __init__(self, pane: int, size: int | None, closed: int | None = None, total: int = 0, counts: dict[int, int] | None = None):
        self.pane, self.size, self.closed, self.total, self.counts = pane, size, closed, total, dict(counts or {})

    def add(self, start: int, n: int) -> None:
        self.counts[start] = self.counts.get(start, 0) + n

    def close(self, until: int) -> list[tuple[int, int]]:
        """(end, sum) of each window that ends by ``until``, where something was counted; without a size, of each pane with rows.

        Panes without rows are stepped over, so a long gap costs nothing.
        """
        out: list[tuple[int, int]] = []
        starts, never = sorted(self.counts), until + 1
        new, old = (0 if self.closed is None else bisect_right(starts, self.closed - self.pane)), 0
        while True:
            comes = starts[new] + self.pane if new < len(starts) else never
            goes = starts[old] + self.size + self.pane if self.size is not None and old < new else never
            slides = self.closed + self.pane if self.size is not None and self.total else never
            end = min(comes, goes, slides)
            if end > until:
                return out
            if comes == end:
                self.total += self.counts[starts[new]]
                if self.size is None:
                    del self.counts[starts[new]]
                new += 1
            if goes == end:  # the inverse step
                self.total -= self.counts.pop(starts[old])
                old += 1
            self.closed = end
            if self.total:
                out.append((end, self.total))

    def next_end(self) -> int | None:
        """When there is something to do next; None if the key holds nothing that can change a sum."""
        opens = [s + self.pane for s in self.counts if self.closed is None or s + self.pane > self.closed]
        if self.size is not None and self.total:
            opens.append(self.closed + self.pane)
        return min(opens, default=None)


class PaneCounts(StatefulProcessor):
    """Rows (bucket, keys..., ms) to (keys..., end_ms, cnt), keys as texts without nulls; one state read and write and one timer for a bucket and batch."""

    def __init__(self, keys: list[str], pane_ms: int, size_ms: int | None):
        self.keys, self.pane, self.size = keys, pane_ms, size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("panes", ", ".join([*[f"k{i} array<string>" for i in range(len(self.keys))], STATE]))

    def _load(self) -> dict[tuple, Panes]:
        if not self.state.exists():
            return {}
        *keys, closed, sums, held, starts, counts = self.state.get()
        out, at = {}, 0
        for key, last, total, n in zip(zip(*keys), closed, sums, held):
            out[key] = Panes(self.pane, self.size, last, total, dict(zip(starts[at : at + n], counts[at : at + n])))
            at += n
        return out

    def _save(self, bucket: dict[tuple, Panes]) -> None:
        dues = {key: panes.next_end() for key, panes in bucket.items()}
        kept = {key: panes for key, panes in bucket.items() if self.size is None or dues[key] is not None}
        if not kept:
            self.state.clear()
            return
        held = list(kept.values())
        self.state.update((
            *[list(part) for part in zip(*kept)], [p.closed for p in held], [p.total for p in held], [len(p.counts) for p in held],
            [start for p in held for start in p.counts], [n for p in held for n in p.counts.values()],
        ))
        due = min((d for d in dues.values() if d is not None), default=None)
        if due is not None:
            self.handle.registerTimer(due)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        bucket = self._load()
        for batch in rows:
            placed = batch[self.keys].assign(ms=batch["ms"] // self.pane * self.pane)
            for (*parts, start), n in placed.groupby([*self.keys, "ms"], sort=False).size().items():
                parts = tuple(parts)
                panes = bucket.get(parts)
                if panes is None:
                    panes = bucket[parts] = Panes(self.pane, self.size)
                if panes.closed is None or start + self.pane > panes.closed:  # a closed pane takes no rows
                    panes.add(int(start), int(n))
        self._save(bucket)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        bucket, mark = self._load(), timerValues.getCurrentWatermarkInMs()
        names, ends, counts = [], [], []
        for parts, panes in bucket.items():
            done = panes.close(mark)
            names += [parts] * len(done)
            ends += [e for e, _ in done]
            counts += [n for _, n in done]
            if len(ends) >= FRAME_ROWS:
                yield self._frame(names, ends, counts)
                names, ends, counts = [], [], []
        self._save(bucket)
        yield self._frame(names, ends, counts)

    def _frame(self, names: list[tuple], ends: list[int], counts: list[int]) -> pd.DataFrame:
        out = {name: pd.Series([parts[i] for parts in names], dtype=object) for i, name in enumerate(self.keys)}
        return pd.DataFrame(out | {"end_ms": pd.Series(ends, dtype="int64"), "cnt": pd.Series(counts, dtype="int64")})

    def close(self) -> None:
        pass


def pane_counts(df: DataFrame, ts: str, keys: list[str], pane: int, size: int | None, late: str, salts: int = 1, salt_by: str | None = None) -> DataFrame:
    """(keys..., salt, end_ms, cnt) of the stream ``df``: for each key and each pane end that the watermark has passed, the count of the last
    ``size`` seconds, or without ``size`` of all time (then only for panes with rows). Windows without rows give no row.

    ``pane`` is in seconds and divides ``size``. Rows older than the watermark (``late`` behind the newest) are dropped, and so are rows without
    time. Null keys count as a key. Keys are split into ``salts`` parts by a hash of ``salt_by``; their types must come back from text.
    Start it within ``keyed_state``, in append mode.
    """
    if size is not None and (size <= 0 or size % pane):
        raise ValueError("pane must divide size")
    salt = F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int") if salt_by and salts > 1 else F.lit(0)
    named = [*keys, "salt"]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields} | {"salt": "int"}
    timed = df.where(F.col(ts).isNotNull()).withColumn("salt", salt).withWatermark(ts, late)
    # A mark before the text tells it from null, which pandas may put into other groups.
    texts = [F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("")).alias(k) for k in named]
    bucket = F.pmod(F.xxhash64(*named), F.lit(BUCKETS)).cast("int").alias("_bucket")
    rows = timed.select(bucket, *texts, ts, F.unix_millis(F.col(ts).cast("timestamp")).alias("ms"))
    shape = ", ".join([*[f"{k} string" for k in named], "end_ms long", "cnt long"])
    work = PaneCounts(named, 1000 * pane, None if size is None else 1000 * size)
    counts = rows.groupBy("_bucket").transformWithStateInPandas(work, shape, "append", "eventTime")
    return counts.select(*[F.when(F.col(k) != "", F.substr(k, F.lit(2))).cast(kinds[k]).alias(k) for k in named], "end_ms", "cnt")


def summed(parts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., end_ms, cnt) of windows from the parts that salts made."""
    return parts.groupBy(*keys, "end_ms").agg(F.sum("cnt").alias("cnt"))
