"""Token counts, packing and piece scan against the libraries themselves."""

import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tidemill.llm import packing, piece_scan, token_counts

SHAPE = "doc_id long, text string, ids string, length int, row int"
PARTS = list("ab  \n\t'th é ñ中文 \xa0 ▁ 12 !\U0001f600ﬁ\x1c\x85ΣİА") + [
    "the", "ing", " don't", "I'll", "   ", "\r\n", "<|endoftext|>", "<|startoftext|>", "<s>", "<unk>", "<0x0A>", "é", " of", "tion", "\x00",
]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], SHAPE).repartition(2)


def texts(seed, n=400):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def edge_rows():
    long = " ".join(f"word{i % 97}" for i in range(40_000))
    return [(0, None), (1, ""), (2, " "), (None, "a b"), (3, long), (3, "again"), (4, "x" * 30_000), (5, "\n" * 5_000)]


@pytest.fixture(scope="module")
def counter():
    with open(P.path("byte_bpe_50k.json"), "rb") as f:
        return token_counts.prefix_table(f.read())


def test_counts_of_random_texts(counter):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for t in texts(1, 3000):
        data = t.encode()
        changes = counter.text(data)
        assert len(changes) == len(data)
        assert token_counts.count_at(changes, len(data)) == len(library.encode(t, add_special_tokens=False).ids), t


def test_count_of_every_prefix(counter):
    """Within a pre-token, and at the ends of words, a prefix has what the library gives for it alone."""
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for word in [" antidisestablishmentarianism", "thereofintheandthat", " 1234567890", "!!!???...", " zxqwvv"]:
        changes = counter.text(word.encode())
        for n in range(1, len(word) + 1):
            assert token_counts.count_at(changes, n) == len(library.encode(word[:n], add_special_tokens=False).ids)
    text = "The cat sat on the mat, and the dog did not."
    changes = counter.text(text.encode())
    for n in [3, 7, 11, 14, 18, 22, 27, 31, 35, 39]:
        assert token_counts.count_at(changes, n) == len(library.encode(text[:n], add_special_tokens=False).ids)
    for budget in range(14):
        cut = token_counts.longest_prefix(changes, budget)
        counts = [0, *np.cumsum(np.frombuffer(changes, np.int8))]
        assert cut == max(n for n, c in enumerate(counts) if c <= budget)


def test_prefix_counts(spark):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rows = edge_rows() + [(10 + i, t) for i, t in enumerate(texts(2, 60))]
    got = token_counts.prefix_counts(table(spark, rows), P.path("byte_bpe_50k.json"), budget=10).collect()
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    assert sorted(((r.doc_id, r.n_bytes, r.n_tokens) for r in got), key=repr) == sorted(want, key=repr)
    for r in got:
        assert r.cut_bytes == token_counts.longest_prefix(bytes(r.changes), 10) and len(r.changes) == r.n_bytes
    assert token_counts.prefix_counts(table(spark, []), P.path("byte_bpe_50k.json")).collect() == []


def test_prefix_counts_needs_its_kind_of_vocabulary():
    with open(P.path("word_bpe_49k.json"), "rb") as f, pytest.raises(ValueError):
        token_counts.PrefixTable(f.read())


# --- packing -------------------------------------------------------------------------------------------


def test_ids_of_random_texts():
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    with open(P.path("word_bpe_49k.json"), "rb") as f:
        encode = packing.WordIds(f.read())
    for t in texts(3, 3000):
        assert np.frombuffer(encode(t.encode()), "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("window,most_open", [(2048, 1024), (64, 8), (8, 2)])
def test_pack(spark, window, most_open):
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    rows = edge_rows() + [(10 + i, t) for i, t in enumerate(texts(4, 120))]
    got = packing.pack(table(spark, rows), P.path("word_bpe_49k.json"), window, 1, most_open).collect()
    want = sorted(([*library.encode(t or "", add_special_tokens=False).ids, 1] for _, t in rows if True), key=len)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        assert r.length > 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    fills = [sum(n for _, n in parts) for parts in sequences.values()]
    assert sum(fills) == sum(map(len, want))
    assert sum(f < window for f in fills) <= 2  # one for each partition
    single = {i: t for i, t in rows if i is not None and i != 3}
    for i, t in single.items():
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted((r for r in got if r.doc_id == i), key=lambda r: r.start):
            piece = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(piece)
            at += r.length
        assert at == len(ids)
    assert packing.pack(table(spark, []), P.path("word_bpe_49k.json")).collect() == []


def test_levels_follow_the_sum_of_squares():
    rng = random.Random(8)
    packer = packing.Packer(20, 10**6, 0)
    for i in range(300):
        before, size = packer.count.copy(), rng.randint(1, 19)
        packer.add(i, bytes(4 * size))
        costs = {0: sum((before + np.eye(21, dtype=int)[size]) ** 2)}
        for h in np.flatnonzero(before):
            if h + size <= 20:
                after = before - np.eye(21, dtype=int)[h] + (np.eye(21, dtype=int)[h + size] if h + size < 20 else 0)
                costs[int(h)] = sum(after**2)
        assert sum(packer.count**2) == min(costs.values())


# --- pieces --------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model():
    with open(P.path("piece_bpe_32k.model"), "rb") as f:
        return f.read()


def chunked(p, text, chunk):
    text, parts, at = p.normal(text), [], 0
    while at < len(text):
        stop = len(text) if len(text) - at - chunk < 2 * p.longest else at + chunk
        begin = max(0, at - p.longest)
        parts.append((text[begin : stop + p.longest], at - begin, stop - begin))
        at = stop
    matrices = [p.matrix(*part) for part in parts]
    states = piece_scan.cut_states(matrices)
    return b"".join(p.chunk(*part, a, b) for part, a, b in zip(parts, states, states[1:])), matrices


def test_pieces_of_random_texts(model):
    p, library = piece_scan.pieces(model), SentencePieceProcessor(model_proto=model)
    for t in texts(5, 2000):
        ids = np.frombuffer(p.between(p.normal(t)), "<u4")
        assert ids.tolist() == library.encode(t), t
        assert p.text_of(ids).decode(errors="replace") == library.decode(ids.tolist())


def test_chunks_give_the_whole_path(model):
    p, library = piece_scan.pieces(model), SentencePieceProcessor(model_proto=model)
    rng = random.Random(6)
    for k in range(40):
        t = "".join(rng.choice(PARTS) for _ in range(300))
        t = t.replace(" ", "").replace("\n", "") if k % 2 else t  # also without any place where paths meet
        ids, matrices = chunked(p, t, 64)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(t)
        if len(matrices) > 2:  # any grouping of the products
            a, b, c = matrices[:3]
            left = piece_scan.multiply(piece_scan.multiply(a, b), c)
            right = piece_scan.multiply(a, piece_scan.multiply(b, c))
            assert sorted(left) == sorted(right)


def test_unigram_chunks_have_the_best_sum(model):
    """With weights that are scores: the chunks' sum is that of the best path over the whole text."""
    p = piece_scan.Pieces(model, unigram=True)
    rng = random.Random(7)
    score = lambda ids: sum(p.library.get_score(i) for i in ids)
    for _ in range(6):
        t = "".join(rng.choice(["the", "ing", "tion", "er", "an", "in", "st"]) for _ in range(80))
        best, _ = p.paths(p.normal(t), 0, len(p.normal(t)), "")
        ids = np.frombuffer(chunked(p, t, 64)[0], "<u4").tolist()
        assert score(ids) == pytest.approx(best[-1]) and p.library.decode(ids) == t


def test_encode_and_decode(spark, model):
    library, path = SentencePieceProcessor(model_proto=model), P.path("piece_bpe_32k.model")
    rows = edge_rows() + [(10 + i, t) for i, t in enumerate(texts(9, 40))]
    encoded = piece_scan.encode(table(spark, rows), path, chunk=2000).cache()
    got = sorted(((r.doc_id, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in encoded.collect()), key=repr)
    assert got == sorted(((i, library.encode(t or "")) for i, t in rows), key=repr)
    back = piece_scan.decode(encoded, path).collect()
    want = sorted(((i, library.decode(library.encode(t or ""))) for i, t in rows), key=repr)
    assert sorted(((r.doc_id, r.text) for r in back), key=repr) == want
    assert piece_scan.encode(table(spark, []), path).collect() == []
    assert piece_scan.decode(spark.createDataFrame([(1, None)], "doc_id long, ids binary"), path).first().text == ""
    encoded.unpersist()
