"""SentencePiece encoding and decoding, with giant texts cut into chunks by a max-plus scan.

An encoding is a best path: each piece adds a weight that depends on the piece before it, and the sum is to be largest. For
a unigram model the weight is the piece's score. For a BPE model it is 0 if the bytes of both pieces together are encoded as
just these two, and minus infinity if not: the one path that is left is the BPE encoding.

A giant text is cut into chunks that different tasks work on. The state at a cut is the piece that covers the character before
it, so a chunk's work is a matrix: the best weight from each state at its left cut to each state at its right one. Such
matrices combine associatively (sums of entries, largest of them kept). Folding them gives the state at every cut, and
then each chunk is traced back alone between its two states.

Where no piece of the vocabulary can reach over a place (before a space, around a line end) all paths meet. So a chunk's
matrix is that of its head and of its tail only, and what lies between is made of units, each worked out once.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import capped, id_and_text, rows, vocabulary

#: Characters of a chunk; longer texts are cut.
CHUNK = 1 << 15
CACHE, CACHE_PAIRS, LONG = 400_000, 500_000, 48
NEVER = float("-inf")
SPACE = "▁"
State = tuple[int, int]  # characters of the piece before the cut, and after it


def _signs(pieces: dict[str, int]) -> set[str]:
    """Punctuation, and what goes with it, that no piece has next to any other character but a space."""
    group: dict[str, str] = {}  # characters that pieces have next to each other, by union-find

    def root(c: str) -> str:
        while group.setdefault(c, c) != c:
            c = group[c]
        return c

    for piece in pieces:
        bare = piece.lstrip(SPACE)
        for a, b in zip(bare, bare[1:]):
            group[root(a)] = root(b)
    main = root("e")
    apart = {root(c) for c in "!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~"} - {main}
    return {c for c in list(group) if root(c) in apart}


class Pieces:
    """Best paths by one SentencePiece model (BPE, or unigram with ``unigram=True``)."""

    def __init__(self, model: bytes, unigram: bool = False):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_proto=model)
        size, lib = self.library.vocab_size(), self.library
        special = [lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i) or lib.is_unused(i) for i in range(size)]
        self.ids = {lib.id_to_piece(i): i for i in range(size) if not special[i]}
        self.score = {p: lib.get_score(i) for p, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        self.byte = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown = None if all(lib.is_byte(i) for i in self.byte) else lib.unk_id()
        self.unigram = unigram
        self.penalty = min(self.score.values()) - 10.0
        joined = "\n".join(p for p in self.ids if len(p) > 1)
        apart = not re.search(f"[^{SPACE}\n]{SPACE}", joined) and not any("\n" in p for p in self.ids if len(p) > 1)
        signs = "".join(map(re.escape, sorted(_signs(self.ids) - {"\n"})))
        words = f"{SPACE}*[^{SPACE}\n{signs}]+" + (f"|{SPACE}*[{signs}]+" if signs else "")
        self.units = re.compile(f"{words}|{SPACE}+|\n") if apart else re.compile(r"[\s\S]+")
        #: Places that no piece reaches over.
        self.seams = re.compile(f"(?<=[^{SPACE}])(?={SPACE})|(?=\n)|(?<=\n)") if apart else re.compile(r"(?!)")
        self.pairs: dict[tuple[str, str], bool] = {}
        self.numbers: dict[int, bool] = {}  # the same by ids, for whole units
        self.piece_of = {i: p for p, i in self.ids.items()}
        self.raw = [np.array([i], dtype="<u4").tobytes() for i in range(size)]
        self.known: dict[str, bytes] = {}

    def normal(self, text: str) -> str:
        return self.library.normalize(text)

    # --- weights ---------------------------------------------------------------------------------------

    def _merged(self, text: str) -> list[str]:
        """BPE by definition, for the few characters of a pair."""
        parts = list(text)
        while len(parts) > 1:
            found = [(-self.score[p], i) for i in range(len(parts) - 1) if (p := parts[i] + parts[i + 1]) in self.score]
            if not found:
                break
            at = min(found)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _compatible(self, before: str, piece: str) -> bool:
        alone = [piece] if not before else [before, piece]
        good = self._merged(before + piece) == alone
        capped(self.pairs, CACHE_PAIRS)[before, piece] = good
        return good

    def weight(self, before: str, piece: str) -> float:
        """Of ``piece`` after ``before`` ('' at the start of a text)."""
        if self.unigram:
            return self.score.get(piece, self.penalty)
        good = self.pairs.get((before, piece))
        return 0.0 if (self._compatible(before, piece) if good is None else good) else NEVER

    def ids_of(self, piece: str) -> bytes:
        if piece in self.ids:
            found = [self.ids[piece]]
        else:
            found = [self.byte[b] for b in piece.encode()] if self.unknown is None else [self.unknown]
        return np.array(found, dtype="<u4").tobytes()

    # --- paths -----------------------------------------------------------------------------------------

    def paths(self, text: str, start: int, end: int, before: str) -> tuple[list[float], list[int]]:
        """(weight, start of the last piece) of the best path from ``start`` to each place up to ``end``."""
        best, back = [NEVER] * (end - start + 1), [-1] * (end - start + 1)
        best[0] = 0.0
        known, longest, first_only = self.ids, self.longest, not self.unigram
        for stop in range(start + 1, end + 1):
            for at in range(max(start, stop - longest), stop):
                if best[at - start] == NEVER:
                    continue
                piece = text[at:stop]
                if piece not in known and stop - at > 1:
                    continue
                w = best[at - start] + self.weight(before if at == start else text[back[at - start] : at], piece)
                if w > best[stop - start]:
                    best[stop - start], back[stop - start] = w, at
                    if first_only:  # no other path is left
                        break
        return best, back

    def trace(self, text: str, start: int, end: int, before: str) -> bytes:
        """Ids of the best path from ``start`` to ``end``."""
        _, back = self.paths(text, start, end, before)
        out, at = [], end
        while at > start:
            out.append(self.ids_of(text[back[at - start] : at]))
            at = back[at - start]
        return b"".join(reversed(out))

    def unit(self, text: str) -> bytes:
        """Ids of one unit. For BPE the only path: each place has one piece that may end there, whatever follows."""
        if self.unigram:
            return self.trace(text, 0, len(text), "")
        ids, numbers, longest = self.ids, self.numbers, self.longest
        last, back = [-1], [0]  # -1: nothing, or a character that the vocabulary does not have
        for stop in range(1, len(text) + 1):
            for at in range(max(0, stop - longest), stop):
                piece = ids.get(text[at:stop], -1)
                if piece < 0:
                    if stop - at > 1:
                        continue
                    break
                pair = (last[at] + 1) << 24 | piece
                good = numbers.get(pair)
                if good is None:
                    good = self._compatible(self.piece_of.get(last[at], ""), self.piece_of[piece])
                    capped(numbers, CACHE_PAIRS)[pair] = good
                if good:
                    break
            last.append(piece)
            back.append(at)
        out, at = [], len(text)
        while at:
            out.append(self.raw[last[at]] if last[at] >= 0 else self.ids_of(text[back[at] : at]))
            at = back[at]
        return b"".join(reversed(out))

    def between(self, text: str) -> bytes:
        """Ids of a text that begins and ends at places which no piece reaches over."""
        units = self.units.findall(text)
        known, fresh = capped(self.known, CACHE), {}
        for unit in set(units).difference(known):
            (known if len(unit) <= LONG else fresh)[unit] = self.unit(unit)
        if not fresh:
            return b"".join(map(known.__getitem__, units))
        return b"".join([known.get(u) or fresh[u] for u in units])

    # --- chunks ----------------------------------------------------------------------------------------

    def states(self, text: str, cut: int) -> list[State]:
        """All pieces of the vocabulary that cover the character before ``cut``, as characters before and after it."""
        out = []
        for at in range(max(0, cut - self.longest), cut):
            for stop in range(cut, min(len(text), at + self.longest) + 1):
                if text[at:stop] in self.ids or stop - at == 1:
                    out.append((cut - at, stop - cut))
        return out

    def _seams(self, text: str, left: int, right: int) -> tuple[int, int] | None:
        """The first and the last place from ``left`` to ``right`` that no piece reaches over."""
        found = self.seams.search(text, left, len(text))
        if found is None or found.start() > right:
            return None
        first = last = found.start()
        step = 1 << 10
        while step < 2 * (right - left + 1):  # the last one is mostly near the end
            near = [m.start() for m in self.seams.finditer(text, max(left, right - step), len(text)) if m.start() <= right]
            if near:
                last = max(near[-1], first)
                break
            step *= 4
        return first, last

    def matrix(self, text: str, left: int, right: int) -> list[tuple[State, State, float]]:
        """Best weight from each state at ``left`` to each at ``right`` that can be reached. ``text`` has at least
        ``longest`` characters more on either side of the chunk, where the whole text has them."""
        sources = self.states(text, left) if left else [(0, 0)]
        ends = self.states(text, right)
        seams = self._seams(text, left, right)
        out = []
        if seams is None:
            for a in sources:
                out += [(a, b, w) for b, w in self._reach(text, left + a[1], text[left - a[0] : left + a[1]], right, ends)]
            return out
        first, last = seams
        heads = []
        for a in sources:
            begin = left + a[1]
            if begin <= first:
                best, _ = self.paths(text, begin, first, text[left - a[0] : begin])
                if best[-1] > NEVER:
                    heads.append((a, best[-1]))
        middle = self._sum(text[first:last]) if self.unigram else 0.0
        tails = self._reach(text, last, "", right, ends)
        return [(a, b, v + middle + w) for a, v in heads for b, w in tails]

    def _sum(self, text: str) -> float:
        return sum(self.paths(u, 0, len(u), "")[0][-1] for u in self.units.findall(text))

    def _reach(self, text: str, start: int, before: str, cut: int, ends: list[State]) -> list[tuple[State, float]]:
        if start > cut:
            return []
        best, back = self.paths(text, start, cut, before)
        out = []
        if start == cut and not before:
            return [((0, 0), 0.0)] if not ends else [(b, 0.0) for b in ends if b[1] == 0]
        for b in ends:
            at, stop = cut - b[0], cut + b[1]
            if at < start or best[at - start] == NEVER:
                continue
            w = best[at - start] + self.weight(before if at == start else text[back[at - start] : at], text[at:stop])
            if w > NEVER:
                out.append((b, w))
        return out

    def chunk(self, text: str, left: int, right: int, a: State, b: State) -> bytes:
        """Ids from after the piece of state ``a`` up to and with that of state ``b``."""
        begin, before = left + a[1], text[left - a[0] : left + a[1]]
        end = right + b[1]
        seams = self._seams(text, left, right)
        if seams is None:
            return self._until(text, begin, end - sum(b), end, before)
        first, last = seams
        tail = b"" if last == end else self._until(text, last, end - sum(b), end, "")
        return self.trace(text, begin, first, before) + self.between(text[first:last]) + tail

    def _until(self, text: str, begin: int, at: int, end: int, before: str) -> bytes:
        return self.trace(text, begin, at, before) + (self.ids_of(text[at:end]) if end > at else b"")

    # --- decoding --------------------------------------------------------------------------------------

    @lru_cache(maxsize=1)  # noqa: B019  one object for each worker
    def _bytes(self) -> list[bytes]:
        lib, out = self.library, []
        for i in range(lib.vocab_size()):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                out.append(bytes([int(piece[3:5], 16)]))
            elif lib.is_control(i):
                out.append(b"")
            else:
                out.append(" ⁇ ".encode() if lib.is_unknown(i) else piece.replace(SPACE, " ").encode())
        return out

    def text_of(self, ids: np.ndarray) -> bytes:
        """The text of ``ids``; the space that encoding puts before a text goes."""
        data = b"".join(map(self._bytes().__getitem__, ids.tolist()))
        return data[1:] if data[:1] == b" " else data


def multiply(a: list[tuple[State, State, float]], b: list[tuple[State, State, float]]) -> list[tuple[State, State, float]]:
    """The max-plus product of two chunks' matrices: that of both chunks together."""
    right: dict[State, list] = {}
    for s, t, w in b:
        right.setdefault(s, []).append((t, w))
    best: dict[tuple[State, State], float] = {}
    for s, middle, v in a:
        for t, w in right.get(middle, ()):
            if v + w > best.get((s, t), NEVER):
                best[s, t] = v + w
    return [(s, t, w) for (s, t), w in best.items()]


def cut_states(matrices: list[list[tuple[State, State, float]]]) -> list[State]:
    """The states at all cuts of a text, the first and the last one included, on the best path."""
    prefix = [matrices[0]]
    for m in matrices[1:]:
        prefix.append(multiply(prefix[-1], m))
    start, state, _ = max(prefix[-1], key=lambda r: (r[2], r[1]))
    states = [state]
    for k in range(len(matrices) - 1, 0, -1):
        reached = {t: w for s, t, w in prefix[k - 1] if s == start}
        _, state = max((reached[s] + w, s) for s, t, w in matrices[k] if t == state and s in reached)
        states.append(state)
    return [start, *reversed(states)]


@lru_cache(maxsize=2)
def pieces(model: bytes, unigram: bool = False) -> Pieces:
    """One object for each model in a worker, whose tasks go on with the units that earlier ones have met."""
    return Pieces(model, unigram)


def encode(docs: DataFrame, model_path: str, chunk: int = CHUNK, unigram: bool = False) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit numbers) of every row's text.

    Ids are those of the SentencePiece library for the model's text, no begin or end added. Texts whose normal form has more
    than ``chunk`` characters are encoded by chunks. ``unigram`` takes the scores as those of a unigram model.

    A null or empty text has no ids (an empty binary). A null doc_id is kept. Rows that repeat a doc_id are
    encoded each. An empty table gives no rows. Other columns are ignored.
    """
    source = vocabulary(docs.sparkSession, model_path)
    longest = max(map(len, pieces(source.value, unigram).ids))
    if chunk < 4 * longest:
        raise ValueError(f"a chunk needs {4 * longest} characters or more")
    named = id_and_text(docs).withColumn("text", F.coalesce("text", F.lit("")))
    size = F.char_length("text")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(source.value, unigram)
        for batch in batches:
            out, held, begin = [], 0, 0
            ids = batch.column("doc_id")
            for i, (_, data) in enumerate(rows(batch)):
                out.append(model.between(model.normal(data.decode())))
                held += len(out[-1])
                if held > 1 << 24 or i + 1 == batch.num_rows:
                    yield pa.record_batch([ids.slice(begin, len(out)), pa.array(out, pa.binary())], names=["doc_id", "ids"])
                    out, held, begin = [], 0, i + 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(source.value, unigram)
        for batch in batches:
            for row, (doc, data) in zip(batch.column("row").to_pylist(), rows(batch)):
                text = model.normal(data.decode())
                n = len(text)
                for at in range(0, n, chunk):
                    # The last chunk takes a short rest along.
                    if at and n - at < 2 * longest:
                        break
                    stop = n if n - at - chunk < 2 * longest else at + chunk
                    begin = max(0, at - longest)
                    part = text[begin : stop + longest]
                    columns = [[row], [doc], [at // chunk], [at - begin], [stop - begin], [part]]
                    yield pa.record_batch(columns, names=["row", "doc_id", "at", "lo", "hi", "part"])

    giant = named.where(size > chunk - 1).withColumn("row", F.monotonically_increasing_id())
    chunks = giant.mapInArrow(cut, "row long, doc_id long, at long, lo long, hi long, part string")
    chunks = cut_lineage(chunks.repartition("row", "at"))

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(source.value, unigram)
        for batch in batches:
            for r in batch.to_pylist():
                found = [(*a, *b, w) for a, b, w in model.matrix(r["part"], r["lo"], r["hi"])]
                packed = np.array(found, dtype=np.float64).tobytes()
                yield pa.record_batch([[r["row"]], [r["at"]], [packed]], names=["row", "at", "matrix"])

    listed = (
        chunks.select("row", "at", "lo", "hi", "part")
        .mapInArrow(matrices, "row long, at long, matrix binary")
        .groupBy("row")
        .agg(F.sort_array(F.collect_list(F.struct("at", "matrix"))).alias("parts"))
    )

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                every = []
                for part in r["parts"]:
                    table = np.frombuffer(part["matrix"]).reshape(-1, 5)
                    every.append([((int(a), int(b)), (int(c), int(d)), w) for a, b, c, d, w in table.tolist()])
                states = cut_states(every)
                out = [(r["row"], p["at"], *a, *b) for p, a, b in zip(r["parts"], states, states[1:])]
                names = ["row", "at", "a0", "a1", "b0", "b1"]
                yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], names=names)

    states = listed.mapInArrow(fold, "row long, at long, a0 long, a1 long, b0 long, b1 long")

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(source.value, unigram)
        for batch in batches:
            for r in batch.to_pylist():
                ids = model.chunk(r["part"], r["lo"], r["hi"], (r["a0"], r["a1"]), (r["b0"], r["b1"]))
                columns = [pa.array([r[c]], pa.int64()) for c in ("row", "doc_id", "at")]
                yield pa.record_batch([*columns, pa.array([ids], pa.binary())], names=["row", "doc_id", "at", "ids"])

    traced = chunks.join(states, ["row", "at"]).mapInArrow(back, "row long, doc_id long, at long, ids binary")
    parts = F.sort_array(F.collect_list(F.struct("at", "ids")))
    ids = F.aggregate(parts, F.lit(b""), lambda all_, p: F.concat(all_, p["ids"]))
    joined = traced.groupBy("row", "doc_id").agg(ids.alias("ids")).select("doc_id", "ids")
    return named.where(size <= chunk - 1).mapInArrow(whole, "doc_id long, ids binary").unionByName(joined)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_pieces, ids_crc32 and text of (doc_id, ids): the text that the library gives for the ids.

    Null ids count as none. The space that encoding puts before a text goes. Other columns are ignored.
    """
    source = vocabulary(encoded.sparkSession, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(source.value)
        for batch in batches:
            out, held, begin = [], 0, 0
            for i, value in enumerate(batch.column("ids")):
                raw = value.as_py() or b""
                text = model.text_of(np.frombuffer(raw, dtype="<u4"))
                out.append((len(raw) // 4, zlib.crc32(raw), text.decode(errors="replace")))
                held += len(text)
                if held > 1 << 24 or i + 1 == batch.num_rows:
                    columns = [pa.array(c, k) for c, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.string()))]
                    ids = batch.column("doc_id").slice(begin, len(out))
                    yield pa.record_batch([ids, *columns], names=["doc_id", "n_pieces", "ids_crc32", "text"])
                    out, held, begin = [], 0, i + 1

    given = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids")
    return given.mapInArrow(run, "doc_id long, n_pieces long, ids_crc32 long, text string")
