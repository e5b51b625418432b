"""Runs of words that repeat with a period, found by recursive frequency splitting and a lag scan.

A run of period q has at least ``turns * q`` words, so each of its words occurs ``turns`` times or more in it. A word that is rarer
than that within a segment of the text can be in no run there and parts the segment; the parts are looked at again, with counts
of their own, until nothing parts. No run is ever cut, since its words pass every count.

What is left is scanned by lags: windows of k words, k doubling, each with the distance to the next equal window. Within a run
of smallest period q, windows of q words or more return after exactly q words and no sooner, so a run of a period in (k/2, k] is a
stretch of windows that all have the lag q, and its ends are those of the run. Windows get their names from the names of their
halves, so a segment of n words costs about n log(n) for each doubling, whatever its periods.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_and_text, rows

TURNS = 4
SHORTEST = 6
#: Bytes of collapsed text in an outgoing batch, about.
OUT_BYTES = 8 << 20
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUN_DDL = "struct<start:long,length:long,period:long>"


def segments(ids: np.ndarray, turns: int = TURNS, shortest: int = SHORTEST) -> list[tuple[int, int]]:
    """(start, end) of the parts of ``ids`` in which every word occurs ``turns`` times or more, each ``shortest`` long or longer.

    A round counts the words of all open segments at once; segments that lose no word are done.
    """
    done: list[tuple[int, int]] = []
    position = np.arange(len(ids))
    segment = np.zeros(len(ids), dtype=np.int64)
    width = int(ids.max()) + 1 if len(ids) else 1
    while len(position):
        _, name, count = np.unique(segment * width + ids[position], return_inverse=True, return_counts=True)
        keep = count[name] >= turns
        lost = np.bincount(segment, weights=~keep) > 0
        position, segment = position[keep], segment[keep]
        if not len(position):
            break
        first = np.flatnonzero(np.concatenate([[True], (np.diff(position) != 1) | (np.diff(segment) != 0)]))
        length = np.diff(np.append(first, len(position)))
        stable = ~lost[segment[first]]
        start = position[first]
        done += [(s, s + n) for s, n in zip(start[stable].tolist(), length[stable].tolist()) if n >= shortest]
        open_ = ~stable & (length >= shortest)
        chosen = np.repeat(open_, length)
        segment = np.repeat(np.cumsum(open_) - 1, length)[chosen]
        position = position[chosen]
    return sorted(done)


def lag_scan(words: np.ndarray, turns: int = TURNS, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """(start, length, period) of the maximal runs of ``words``, with their smallest periods."""
    found = []
    _, names = np.unique(words, return_inverse=True)
    k = 1
    while len(names) > 1 and turns * (k // 2 + 1) <= len(words):
        order = np.argsort(names, kind="stable")
        again = np.flatnonzero(names[order][1:] == names[order][:-1])
        if not len(again):
            break
        lag = np.zeros(len(names), dtype=np.int64)
        lag[order[again]] = order[again + 1] - order[again]
        lag[(lag <= k // 2) | (lag > k)] = 0
        first = np.flatnonzero(np.concatenate([[True], np.diff(lag) != 0]))
        count = np.diff(np.append(first, len(lag)))
        period = lag[first]
        length = count - 1 + period + k
        good = (period > 0) & (length >= np.maximum(shortest, turns * period))
        found += zip(first[good].tolist(), length[good].tolist(), period[good].tolist())
        if len(names) <= k:
            break
        _, names = np.unique(names[:-k] * (int(names.max()) + 1) + names[k:], return_inverse=True)
        k *= 2
    return found


def runs_of(words: list[bytes], turns: int = TURNS, shortest: int = SHORTEST) -> list[tuple[int, int, int]]:
    """The runs of a text's words, by start, then period."""
    if len(words) < shortest:
        return []
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))
    found = []
    for start, end in segments(ids, turns, shortest):
        found += [(start + s, n, q) for s, n, q in lag_scan(ids[start:end], turns, shortest)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period, compared without rounding; of equals the first, then the shorter period."""
    best = None
    for run in runs:  # by start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words joined by one space, without those that a run holds after its first period."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()])


def find_runs(docs: DataFrame, turns: int = TURNS, shortest: int = SHORTEST) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, runs (by start, then period), strongest, collapsed.

    Words are what lies between ASCII white space in the whole ``text``, numbered from 0. A run is a stretch of consecutive words
    with smallest period q, of ``max(shortest, turns * q)`` words or more, that no neighbouring word extends. ``strongest`` has the
    greatest length / period (of equals the smallest start, then period). ``collapsed`` is the text with each run
    cut to its first period, words joined by one space.

    A null or empty text has no words, no runs, a null ``strongest`` and an empty ``collapsed``. Rows that repeat a doc_id, or have
    none, are worked out each. Other columns are ignored. An empty table gives no rows. A text is worked on by one task, in
    memory that grows with its own words.
    """
    if turns < 4 or shortest < 2:
        raise ValueError("turns must be 4 or more, shortest 2 or more")
    names = ["doc_id", "n_words", "runs", "strongest", "collapsed"]

    def table(columns: list[list]) -> pa.RecordBatch:
        ids, n, runs, best, text = columns
        found = pa.array([[dict(zip(("start", "length", "period"), r)) for r in some] for some in runs], pa.list_(RUN))
        top = pa.array([r and dict(zip(("start", "length", "period"), r)) for r in best], RUN)
        out = [pa.array(ids, pa.int64()), pa.array(n, pa.int64()), found, top, pa.array(text, pa.binary()).cast(pa.string())]
        return pa.record_batch(out, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, size = [[] for _ in names], 0
            for doc_id, data in rows(batch):
                words = (data or b"").split()
                runs = runs_of(words, turns, shortest)
                text = collapse(words, runs)
                for column, value in zip(columns, (doc_id, len(words), runs, strongest(runs), text)):
                    column.append(value)
                size += len(text) + 64
                if size > OUT_BYTES:
                    yield table(columns)
                    columns, size = [[] for _ in names], 0
            if columns[0]:
                yield table(columns)

    return id_and_text(docs).mapInArrow(run, f"doc_id long, n_words long, runs array<{RUN_DDL}>, strongest {RUN_DDL}, collapsed string")
