"""Exact token counts of every prefix of a text, for byte-level BPE vocabularies.

A prefix's encoding under BPE ends in exactly one token t for which the encoding of the shorter prefix before t, followed
by t, holds only *compatible* neighbours: two tokens are compatible if the bytes of both together are encoded as just these
two. So a table over the prefixes, each entry made from entries before it, gives the last token and the
number of tokens of every prefix in one pass, without encoding any prefix again. Texts are split into the vocabulary's
pre-tokens first, and the table of a pre-token is worked out once for each distinct one; a text's table is
theirs in a row.

The table is stored as one signed byte for each byte of text, the change of the count (a longer prefix can have
fewer tokens), so the count of any prefix is a sum: ``count_at``, ``longest_prefix`` and ``over`` answer budget and
truncation questions from it alone.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import SPACE, blocks, capped, id_and_text, rows, vocabulary

#: Fixed value: the pattern by which this kind of vocabulary splits a text before its merges.
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Entries of each cache of a worker, and bytes of the longest pre-token that is kept in one.
CACHE, CACHE_PAIRS, LONG = 500_000, 500_000, 64
#: A word with the one space before it, or white space without the last of a run that a word follows.
_UNITS = re.compile(rb" ?[^" + SPACE + rb"]+|[" + SPACE + rb"]+(?![^" + SPACE + rb"])|[" + SPACE + rb"]+")
#: White space beyond ASCII (fixed values): texts with it are split by the full pattern.
_WIDE = [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_WIDE_SPACE = re.compile(b"|".join(chr(c).encode() for c in _WIDE))


def _byte_alphabet() -> dict[str, int]:
    """Printable stand-in of every byte in byte-level vocabularies -> the byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return table | {chr(0x100 + i): b for i, b in enumerate(rest)}


class PrefixTable:
    """Prefix counts by one vocabulary file of the ``tokenizers`` library (byte-level BPE)."""

    def __init__(self, definition: bytes):
        import regex

        spec = json.loads(definition)
        model, pre = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or pre["type"] != "ByteLevel" or spec["normalizer"] or pre["add_prefix_space"]:
            raise ValueError("a byte-level BPE vocabulary without normaliser is needed")
        alphabet = _byte_alphabet()
        raw = {name: bytes(alphabet[c] for c in name) for name in model["vocab"] if all(c in alphabet for c in name)}
        self.ids = {b: model["vocab"][name] for name, b in raw.items()}
        self.bytes_of = {i: b for b, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for order, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            a, b = raw[a], raw[b]
            self.rank[self.ids[a], self.ids[b]] = (order, self.ids[a + b])
        self.special = [t["content"].encode() for t in spec.get("added_tokens") or []]
        self.at_special = re.compile(b"|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.split = regex.compile(PRE_TOKENS)
        self.pairs: dict[tuple[int, int], bool] = {}
        self.known: dict[bytes, bytes] = {}
        self.units: dict[bytes, bytes] = {}

    def _merged(self, data: bytes) -> list[int]:
        """BPE by definition, for the few bytes of a pair."""
        parts = [self.ids[data[i : i + 1]] for i in range(len(data))]
        while len(parts) > 1:
            found = [(self.rank[p][0], i) for i, p in enumerate(zip(parts, parts[1:])) if p in self.rank]
            if not found:
                break
            order, at = min(found)
            a, b = parts[at], parts[at + 1]
            new, out, i = self.rank[a, b][1], [], 0
            while i < len(parts):
                if i + 1 < len(parts) and parts[i] == a and parts[i + 1] == b:
                    out.append(new)
                    i += 2
                else:
                    out.append(parts[i])
                    i += 1
            parts = out
        return parts

    def _compatible(self, a: int, b: int) -> bool:
        """``a`` may come before ``b``; -1 stands for the start, where a token must be what its own bytes give."""
        tokens = [b] if a < 0 else [a, b]
        good = self._merged(b"".join(map(self.bytes_of.__getitem__, tokens))) == tokens
        capped(self.pairs, CACHE_PAIRS)[a, b] = good
        return good

    def pre_token(self, data: bytes) -> bytes:
        """Changes of the token count over the prefixes of one pre-token (of 1 byte, 2 bytes and so on)."""
        ids, pairs, longest = self.ids, self.pairs, self.longest
        last, count, change = [-1], [0], bytearray()
        for end in range(1, len(data) + 1):
            for start in range(max(0, end - longest), end):
                token = ids.get(data[start:end])
                if token is None:
                    continue
                pair = last[start], token
                good = pairs.get(pair)
                if good is None:
                    good = self._compatible(*pair)
                if good:
                    break
            else:
                raise ValueError(f"no encoding ends at byte {end} of {data[:40]!r}")
            last.append(token)
            count.append(count[start] + 1)
            change.append((count[end] - count[end - 1]) & 255)
        return bytes(change)

    def unit(self, data: bytes) -> bytes:
        """Changes over text that its neighbours do not affect."""
        out = []
        for piece in self.split.findall(data.decode()):
            raw = piece.encode()
            known = self.known.get(raw)
            if known is None:
                known = self.pre_token(raw)
                if len(raw) <= LONG:
                    capped(self.known, CACHE)[raw] = known
            out.append(known)
        return out[0] if len(out) == 1 else b"".join(out)

    def _plain(self, data: bytes) -> bytes:
        if _WIDE_SPACE.search(data):
            return self.unit(data)
        out = []
        for block in blocks(data):
            units = _UNITS.findall(block)
            known = capped(self.units, CACHE)
            for new in set(units).difference(known):
                known[new] = self.unit(new)
            out.append(b"".join(map(known.__getitem__, units)))
        return b"".join(out)

    def text(self, data: bytes) -> bytes:
        """Changes over a whole text; a special string is one token, counted at its last byte."""
        out, start = [], 0
        ends = [m.span() for m in self.at_special.finditer(data)] if self.at_special else []
        for begin, end in [*ends, (len(data), len(data))]:
            if begin > start:
                out.append(self._plain(data[start:begin]))
            if end > begin:
                out.append(bytes(end - begin - 1) + b"\x01")
            start = end
        return b"".join(out)


@lru_cache(maxsize=2)
def prefix_table(definition: bytes) -> PrefixTable:
    """One object for each vocabulary in a worker, whose tasks go on with the units that earlier ones have met."""
    return PrefixTable(definition)


def count_at(changes: bytes, n_bytes: int) -> int:
    """Tokens of the first ``n_bytes`` bytes."""
    return int(np.frombuffer(changes, dtype=np.int8)[:n_bytes].sum(dtype=np.int64))


def longest_prefix(changes: bytes, budget: int) -> int:
    """Bytes of the longest prefix of at most ``budget`` tokens."""
    counts = np.cumsum(np.frombuffer(changes, dtype=np.int8), dtype=np.int64)
    fits = np.flatnonzero(counts <= budget)
    return int(fits[-1]) + 1 if len(fits) else 0


def prefix_counts(docs: DataFrame, vocabulary_path: str, budget: int = 1024, table: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_tokens, cut_bytes and (with ``table``) ``changes``, the stored table of prefix counts.

    ``n_tokens`` is what the library counts for the whole text, no tokens added. ``cut_bytes`` is the length of the
    longest prefix of at most ``budget`` tokens (a prefix counts as its share of the text's pre-tokens, which is what
    the library gives for it alone unless the cut lies within a run of white space or a contraction).

    A null text counts as empty (0 bytes, 0 tokens, an empty table). A null doc_id is kept. Each row counts for itself, repeated
    doc_ids too. An empty table gives no rows. Other columns are ignored.
    """
    source = vocabulary(docs.sparkSession, vocabulary_path)
    schema = "doc_id long, n_bytes long, n_tokens long, cut_bytes long" + ", changes binary" * table
    kinds = [pa.int64()] * 4 + [pa.binary()] * table
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = prefix_table(source.value)
        for batch in batches:
            out, held = [], 0
            for doc_id, data in rows(batch):
                data = data or b""
                changes = counter.text(data)
                tokens = count_at(changes, len(data))
                cut = len(data) if tokens <= budget else longest_prefix(changes, budget)
                out.append((doc_id, len(data), tokens, cut, changes) if table else (doc_id, len(data), tokens, cut))
                held += len(changes) * table
                if held > 1 << 24:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)
                    out, held = [], 0
            if out:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return id_and_text(docs).mapInArrow(run, schema)
