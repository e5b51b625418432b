"""Sum-of-squares online packing of token sequences into windows of fixed length.

Each partition of the input is packed alone, in its order, so nothing is shuffled and a lost task is simply
run again. A document's ids are cut into whole windows and a rest. The rest goes to the fill level that
makes the sum of squares of N(h) smallest, N(h) being the number of open windows that hold h ids: this keeps
open windows of all levels at hand, so that a fitting one is likely for every rest. N is an array with one
entry per level; a window leaves it when it is full. When more than ``most_open`` windows are open, and at the
end of the partition, the emptiest windows are cut up to fill the fullest ones. What stays padded is one
window of each partition, and the ids held in memory are bounded by ``most_open`` windows.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .common import Generations, blocks, capped, id_and_text, rows, vocabulary

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)
ARROW = pa.schema([(c.split()[0], pa.int64()) for c in PIECES.split(", ")])
#: Sequence ids are partition << SHIFT | number within the partition.
SHIFT = 36
CACHE_WORDS, CACHE_PIECES = 100_000, 300_000


class WordIds:
    """Ids of texts by a ``tokenizers`` vocabulary that drops white space, composes, lower-cases and marks word ends.

    There each white-space separated word is encoded alone, so a text's ids are those of its words in a row. Plain text
    (Latin-1 letters, digits and signs, which compose to themselves) is split here into the vocabulary's pre-tokens, none of which
    crosses white space, and the library sees each distinct pre-token once. In other text, words that are not plain go to the
    library whole.
    """

    def __init__(self, definition: bytes):
        import regex
        from tokenizers import Tokenizer

        spec = json.loads(definition)
        steps = [n["type"] for n in spec["normalizer"]["normalizers"]]
        ending = spec["model"]["end_of_word_suffix"]
        if steps != ["NFC", "Replace", "Lowercase"] or not ending:
            raise ValueError("a vocabulary that drops white space, lower-cases and marks word ends is needed")
        self.library = Tokenizer.from_str(definition.decode())
        self.library.no_truncation()
        self.library.no_padding()
        self.split = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        # A plain word: no white space of Latin-1 and nothing that may begin a special string.
        self.plain = re.compile("[\x00-\x08\x0e-\x1f!-;=-\x84\x86-\x9f\xa1-\xff]+")
        self.plain_text = re.compile("[\t-\r !-;=-~\xa1-\xac\xae-\xff]*")
        # The vocabulary's own pattern with its letters and numbers spelled out as far as plain text has them, for the faster engine.
        letters, numbers = ("".join(c for c in map(chr, range(256)) if unicodedata.category(c)[0] == x) for x in "LN")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split_plain = re.compile(pattern.replace("\\p{L}", letters).replace("\\p{N}", numbers))
        vocab = spec["model"]["vocab"]
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for name, i in vocab.items() if name.endswith(ending)]] = True
        self.pre = Generations(CACHE_PIECES)
        self.known: dict[bytes, bytes] = {}

    def learn(self, words: set[bytes]) -> None:
        parts: dict[bytes, list[str]] = {}
        for word in words:
            text = word.decode()
            if self.plain.fullmatch(text):
                parts[word] = self.split.findall(text.lower())
            else:
                self.known[word] = np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        pre = self._learn_pre({p for some in parts.values() for p in some})
        for word, some in parts.items():
            self.known[word] = pre[some[0]] if len(some) == 1 else b"".join(map(pre.__getitem__, some))

    def _learn_pre(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of pre-tokens, those of ``pieces`` among them."""
        new = list(self.pre.fresh(pieces))
        for at in range(0, len(new), 2000):
            part = new[at : at + 2000]
            ids = np.array(self.library.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            ends = 4 * (np.flatnonzero(self.ends[ids]) + 1)
            if len(ends) != len(part):
                raise ValueError("the vocabulary splits its own pre-tokens")
            raw, begin = ids.tobytes(), 0
            for piece, end in zip(part, ends.tolist()):
                self.pre.young[piece] = raw[begin:end]
                begin = end
        return self.pre.young

    def __call__(self, data: bytes) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        out = []
        for block in blocks(data):
            text = block.decode()
            if self.plain_text.fullmatch(text):
                parts = self.split_plain.findall(text.lower())
                out.append(b"".join(map(self._learn_pre(set(parts)).__getitem__, parts)))
                continue
            words = block.split()
            known = capped(self.known, CACHE_WORDS)
            new = set(words).difference(known)
            if new:
                self.learn(new)
            out.append(b"".join(map(known.__getitem__, words)))
        return b"".join(out)


@lru_cache(maxsize=2)
def word_ids(definition: bytes) -> WordIds:
    """One object for each vocabulary in a worker, whose tasks go on with the words that earlier ones have met."""
    return WordIds(definition)


class Packer:
    """Online packing of one partition; ``pieces`` yields the rows of the windows that are done."""

    def __init__(self, window: int, most_open: int, first_id: int):
        self.window, self.most_open, self.next_id = window, most_open, first_id
        self.count = np.zeros(window + 1, dtype=np.int64)  # N(h); 0 and window stay 0
        self.open: list[list[list]] = [[] for _ in range(window)]  # by fill level: windows, each a list of parts
        self.total = 0
        self.done: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        n = len(ids) // 4
        whole = n - n % self.window
        for start in range(0, whole, self.window):
            self._close([(doc_id, start, ids[4 * start : 4 * (start + self.window)], n)])
        if n > whole:
            self._place((doc_id, whole, ids[4 * whole :], n))

    def _place(self, part: tuple) -> None:
        s = len(part[2]) // 4
        level = self._level(s)
        window = self._take(level) if level else []
        window.append(part)
        if level + s == self.window:
            self._close(window)
            return
        self._keep(window, level + s)
        if self.total > self.most_open:
            self.compact(self.most_open // 2)

    def _level(self, s: int) -> int:
        """The level whose use changes the sum of squares least (0: a new window); of equals the fullest."""
        used = np.flatnonzero(self.count[: self.window - s + 1])
        best, change = 0, 2 * self.count[s] + 1
        if len(used):
            cost = 2 * (self.count[used + s] - self.count[used] + 1)
            cost[used + s == self.window] -= 1  # a full window is no longer counted
            at = len(used) - 1 - int(np.argmin(cost[::-1]))
            if cost[at] <= change:
                best = int(used[at])
        return best

    def _take(self, level: int) -> list:
        self.count[level] -= 1
        self.total -= 1
        return self.open[level].pop()

    def _keep(self, window: list, level: int) -> None:
        self.count[level] += 1
        self.total += 1
        self.open[level].append(window)

    def _close(self, window: list) -> None:
        offset = 0
        for doc_id, start, ids, n in window:
            length = len(ids) // 4
            self.done.append((doc_id, start, length, zlib.crc32(ids), n, self.next_id, offset))
            offset += length
        self.next_id += 1

    def compact(self, left: int) -> None:
        """Cut up the emptiest windows to fill the fullest until at most ``left`` are open."""
        windows = [(h, w) for h in np.flatnonzero(self.count).tolist() for w in self.open[h]]
        self.open = [[] for _ in range(self.window)]
        self.count[:], self.total = 0, 0
        low, high = 0, len(windows) - 1
        spare: list[tuple] = []  # parts of the window that is being cut up
        while high - low + 1 + bool(spare) > left and (low < high or (spare and low <= high)):
            if not spare:
                spare = windows[low][1]
                low += 1
            level, window = windows[high]
            gap = self.window - level
            while spare and gap:
                doc_id, start, ids, n = spare.pop()
                take = min(gap, len(ids) // 4)
                window.append((doc_id, start, ids[: 4 * take], n))
                if take < len(ids) // 4:
                    spare.append((doc_id, start + take, ids[4 * take :], n))
                gap -= take
            windows[high] = (self.window - gap, window)
            if gap == 0:
                self._close(window)
                high -= 1
        for h, w in windows[low : high + 1]:
            self._keep(w, h)
        if spare:
            self._keep(spare, sum(len(p[2]) // 4 for p in spare))

    def finish(self) -> None:
        self.compact(1)
        for h in np.flatnonzero(self.count).tolist():
            for w in self.open[h]:
                self._close(w)

    def pieces(self) -> Iterator[pa.RecordBatch]:
        if self.done:
            columns = list(zip(*self.done))
            self.done = []
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=ARROW)


def pack(
    docs: DataFrame, vocabulary_path: str, window: int = 2048, end_id: int = 1, most_open: int = 1024
) -> DataFrame:
    """One row for each piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is the ids of its text (``vocabulary_path``, a file of the ``tokenizers`` library whose vocabulary drops
    white space; no special tokens added) and then ``end_id``. Each id lies in one piece; ``offset`` counts a sequence's
    ids before the piece, without gaps; sequences hold at most ``window`` ids and one in each partition may hold fewer.
    ``ids_crc32`` is of the piece's ids as little-endian unsigned 32-bit numbers.

    A null or empty text is ``end_id`` alone. A null doc_id is kept as null. Rows that repeat a doc_id are documents of
    their own. An empty table gives no rows. Other columns are ignored.
    """
    if window < 2 or most_open < 2:
        raise ValueError("window and most_open must be 2 or more")
    source = vocabulary(docs.sparkSession, vocabulary_path)
    last = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(source.value)
        packer = Packer(window, most_open, TaskContext.get().partitionId() << SHIFT)
        for batch in batches:
            for doc_id, data in rows(batch):
                packer.add(doc_id, encode(data or b"") + last)
                if len(packer.done) >= 10_000:
                    yield from packer.pieces()
        packer.finish()
        yield from packer.pieces()

    return id_and_text(docs).mapInArrow(run, PIECES)
