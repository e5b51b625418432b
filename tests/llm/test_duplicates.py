"""Exact duplicates, near duplicates and repeated passages against plain versions on small fixtures."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import exact_dedup as X
from tidemill.llm import ngram_join as N
from tidemill.llm import substring_dedup as S

SHAPE = "doc_id long, text string, row int, sha string, kind string, key string, place string"


def table(spark, rows):
    """Documents with extra columns whose names clash with internal ones."""
    full = [(i, t, 1, "x", "y", "z", "w") for i, t in rows]
    return spark.createDataFrame(full, SHAPE).repartition(3)


WORDS = [f"w{i}" for i in range(400)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edge_rows(rng):
    base = prose(rng, 60)
    return [
        (1, None), (2, ""), (3, " \t"), (4, base), (5, base.replace(" ", "\n ")), (6, base + " "), (None, base), (None, None), (4, base),
        (7, "x" * 70_000), (8, "x" * 70_000), (9, prose(rng, 3)), (9, prose(rng, 4)), (10, "é 中 a b"), (11, "é\t\t中 a b"),
    ]


# --- exact ---------------------------------------------------------------------------------------------


def plain_groups(rows):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    by = {}
    for i, t in norm:
        by.setdefault(t, []).append(i)
    first = {t: min((i is None, i) for i in ids if True)[1] if any(i is not None for i in ids) else None for t, ids in by.items()}
    return sorted(
        ((i, first[t], len(by[t]), hashlib.sha256(t.encode()).hexdigest()) for i, t in norm), key=repr
    )


@pytest.mark.parametrize("huge,weak", [(X.HUGE, None), (50, None), (X.HUGE, 0), (50, 2)])
def test_exact_dedup(spark, huge, weak):
    rng = random.Random(3)
    rows = edge_rows(rng) + [(20 + i, prose(rng, rng.randint(0, 3))) for i in range(30)]
    got = X.exact_dedup(table(spark, rows), huge, 17, weak).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == plain_groups(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)


def test_exact_dedup_empty(spark):
    assert X.exact_dedup(table(spark, [])).collect() == []
    assert X.drop_copies(table(spark, [])).count() == 0


def test_fingerprints_combine():
    rng = random.Random(5)
    text = "".join(rng.choice("ab \n") for _ in range(30_000)).encode()
    whole = X.fingerprint(X.normalise(text))
    for size in (1, 7, 4096, 9000):
        parts = [X.fingerprint(X.normalise(text[i : i + size])) for i in range(0, len(text), size)]
        while len(parts) > 1:  # in any grouping
            i = rng.randrange(len(parts) - 1)
            parts[i : i + 2] = [X.combine(parts[i], parts[i + 1])]
        assert parts[0] == whole
    value = 0
    for b in X.normalise(text):
        value = (value * X.MODULI[0][1] + b) % X.MODULI[0][0]
    assert whole.h1 == value


def test_drop_copies(spark):
    rng = random.Random(4)
    rows = [(i, prose(rng, 5) if i % 3 else "same  text") for i in range(12)]
    kept = X.drop_copies(table(spark, rows))
    assert kept.columns == [c.split()[0] for c in SHAPE.split(", ")]
    assert sorted(r.doc_id for r in kept.collect()) == sorted([0, *(i for i in range(12) if i % 3)])
    mixed = [*rows, (1, rows[1][1]), (None, "lone"), (0, "other")]
    found = [(r.doc_id, r.text) for r in X.drop_copies(table(spark, mixed)).collect()]
    assert len(found) == len(set(found)) == 1 + 8 + 2


# --- near ----------------------------------------------------------------------------------------------


def plain_components(rows, percent=80, width=5):
    sets = {}
    for k, (i, t) in enumerate(rows):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", lower)
        sets[k] = {tuple(w[j : j + width]) for j in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        i, j, common = rows[a][0], rows[b][0], len(sets[a] & sets[b])
        if i is None or j is None or not common or 100 * common < percent * len(sets[a] | sets[b]):
            continue
        i, j = sorted((root(i), root(j)))
        parent[j] = i
    return sorted(((i, len(sets[k]), None if i is None else root(i)) for k, (i, t) in enumerate(rows)), key=repr)


def mutated(rng, words, share):
    out = []
    for w in words:
        x = rng.random()
        if x < share / 3:
            continue
        out.append(rng.choice(WORDS) if x < 2 * share / 3 else w)
        if x > 1 - share / 3:
            out.append(rng.choice(WORDS))
    return out


def near_rows(seed, n=150):
    """Chains of edits, so that similarities lie on both sides of the limit and classes hold indirect links."""
    rng = random.Random(seed)
    rows, texts = [], [prose(rng, rng.choice([4, 6, 9, 15, 40, 120])).split() for _ in range(8)]
    for i in range(n):
        words = mutated(rng, rng.choice(texts), rng.choice([0, 0.01, 0.03, 0.05, 0.1]))
        if rng.random() < 0.5:
            texts.append(words)
        rows.append((i, rng.choice([" ", "\n"]).join(w.upper() if rng.random() < 0.1 else w for w in words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_near_components(spark, seed):
    rows = near_rows(seed)
    rng = random.Random(seed)
    rows += edge_rows(rng) if seed == 1 else []
    got = N.near_components(table(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == plain_components(rows)


def test_links_hang_on_no_list_of_common_shingles(spark, monkeypatch):
    rows = near_rows(4)
    want = plain_components(rows)
    every = N.common_shingles(table(spark, rows), 5, at_least=1)
    for common in (every[:0], N.common_shingles(table(spark, rows), 5), every):
        monkeypatch.setattr(N, "common_shingles", lambda docs, width, common=common: common)
        got = N.near_components(table(spark, rows)).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == want
        monkeypatch.undo()


def test_near_components_other_limits(spark):
    rows = near_rows(7, 60)
    got = N.near_components(table(spark, rows), percent=50, width=2).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == plain_components(rows, 50, 2)
    assert N.near_components(table(spark, [])).collect() == []
    with pytest.raises(ValueError):
        N.near_components(table(spark, []), percent=0)


def test_documents_apart_within_a_group(spark):
    """Documents that all share keys with the smallest one, which most of them do not link with."""
    rng = random.Random(11)
    centre = prose(rng, 80).split()
    rows = [(0, " ".join(centre))]
    for k in range(1, 9):
        part = centre[:40] + prose(rng, 25 + k).split()
        rows += [(10 * k + j, " ".join(mutated(rng, part, 0.02))) for j in range(4)]
    got = N.near_components(table(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == plain_components(rows)


def large_group(rng, classes=60, size=2):
    """Copies of edited copies of one long text, so that similarities lie on both sides of the limit."""
    base, rows = prose(rng, 200).split(), []
    for k in range(classes):
        own = mutated(rng, base, 0.018)
        rows += [(100 * k + j, " ".join(mutated(rng, own, 0.006))) for j in range(size)]
    return rows


@pytest.mark.parametrize("docs,shingles", [(256, 500_000), (7, 10**6), (10**6, 2000)])
def test_a_large_group_gives_rows_by_its_documents(spark, monkeypatch, docs, shingles):
    """What goes on from a group of documents that do not link grows with the documents, not with their pairs."""
    monkeypatch.setattr(N, "BLOCK_DOCS", docs)
    monkeypatch.setattr(N, "BLOCK_SHINGLES", shingles)
    rows, seen, apart = large_group(random.Random(21)), [], N._apart

    def counted(*args):
        seen.append(apart(*args))
        return seen[-1]

    monkeypatch.setattr(N, "_apart", counted)
    got = N.near_components(table(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == plain_components(rows)
    assert 0 < seen[0].count() < 2 * len(rows)


def test_a_group_gives_back_a_row_a_document():
    """40 documents of one group that all may link with each other: 780 pairs stay in the task."""
    import pyarrow as pa
    from fractions import Fraction

    n = 40
    same = {name: [value] * n for name, value in (("key", 1), ("lo", 0), ("hi", 0), ("block", 0), ("n", 50), ("own", 50))}
    sketch = pa.array([[{"low": 50, "bits": [3, 5]}]] * n, pa.list_(pa.struct([("low", pa.int64()), ("bits", pa.list_(pa.int64()))])))
    batch = pa.RecordBatch.from_pydict(same | {"doc": list(range(n)), "component": list(range(n)), "sketches": sketch})
    out = pa.Table.from_batches(N._held_to_each_other(Fraction(4, 5))(iter([batch])))
    assert sorted(zip(out["doc"].to_pylist(), out["centre"].to_pylist())) == [(i, 0) for i in range(1, n)]


def test_linked_and_gathered():
    from fractions import Fraction

    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 100, dtype=np.uint64)
    held = [(i, i, i, np.unique(np.append(base[: 100 - 6 * (i % 5)], rng.integers(0, 2**63, 3 * (i % 7), dtype=np.uint64)))) for i in range(40)]
    pairs = itertools.combinations(range(40), 2)
    common = {(a, b): len(np.intersect1d(held[a][3], held[b][3])) for a, b in pairs}
    links = [p for p, c in common.items() if 5 * c >= 4 * (len(held[p[0]][3]) + len(held[p[1]][3]) - c)]
    ends = N._linked(held, Fraction(4, 5))
    member, centre = N._gathered(*np.array(links).T)
    assert 0 < len(links) < len(common)
    assert set(zip(*[c.to_pylist() for c in ends.columns])) == set(zip(member.tolist(), centre.tolist()))
    assert N._linked([], Fraction(4, 5)).num_rows == 0
    assert [e.tolist() for e in N._gathered(np.array([5, 9, 2, 8]), np.array([4, 8, 4, 8]))] == [[4, 5, 9], [2, 2, 8]]


def test_every_pair_within_reach_shares_a_key():
    import numpy as np
    from fractions import Fraction

    rng, bands = np.random.default_rng(3), N.Bands(Fraction(4, 5))
    for n in [1, 2, 4, 5, 9, 10, 24, 25, 60, 200, 999]:
        for _ in range(20):
            common = rng.integers(0, 2**63, n, dtype=np.uint64)
            apart = int(n / 4)  # the most that similarity 0.8 leaves
            left = int(rng.integers(0, apart + 1))
            more = rng.integers(0, 2**63, apart, dtype=np.uint64)
            a, b = np.unique(np.append(common, more[:left])), np.unique(np.append(common, more[left:]))
            called = np.unique(rng.choice(common, rng.integers(0, n + 1)))  # whatever is called common
            marks = [np.isin(x, called) for x in (a, b)]
            assert np.intersect1d(N._keys(a, marks[0], bands), N._keys(b, marks[1], bands)).size


def test_keep_one(spark):
    rows = near_rows(5, 60)
    stay = {i for i, _, c in plain_components(rows) if i == c}
    kept = N.keep_one(table(spark, rows))
    assert {r.doc_id for r in kept.collect()} == stay and "place" in kept.columns


# --- passages ------------------------------------------------------------------------------------------


def windows_held_before(rows, size=S.MIN_BYTES):
    """(doc_id, set of bytes) in windows of ``size`` bytes that a document of smaller doc_id holds, one by one."""
    first, out = {}, {}
    for i, t in sorted((i, t) for i, t in rows if i is not None and t):
        data = t.encode()
        for a in range(len(data) - size + 1):
            if first.setdefault(data[a : a + size], i) != i:
                out.setdefault(i, set()).update(range(a, a + size))
    return out


def check_spans(spans, rows, most_left=16):
    """Spans against all windows: nothing that no earlier document holds, and of what one holds all but fewer than ``most_left`` bytes at an
    end, which a later holder of the passage shares by chance and its first one does not."""
    want, found = windows_held_before(rows), {}
    for i, start, length in spans:
        assert length >= S.MIN_BYTES
        found.setdefault(i, set()).update(range(start, start + length))
    assert set(found) == set(want)
    for i, held in want.items():
        assert found[i] <= held
        left = np.sort(np.fromiter(held - found[i], dtype=np.int64))
        parts = np.split(left, np.flatnonzero(np.diff(left) > 1) + 1)
        assert all(len(part) < most_left for part in parts), (i, parts)


def passage_rows():
    rng = random.Random(9)
    shared = [prose(rng, n) for n in (55, 60, 90)]
    rows = [(i, prose(rng, 80) + " " + shared[i % 3] + " " + prose(rng, 40 + i)) for i in range(30)]
    rows += [(100 + i, prose(rng, 120)) for i in range(20)] + [(200, "ab " * 3000), (201, "zz " + "ab " * 2000), (202, "é" * 5000)]
    return rows, shared


def test_repeated_passages(spark):
    rows, shared = passage_rows()
    odd = [(300, None), (301, ""), (None, rows[0][1])]
    got = {(r.doc_id, r.start, r.length) for r in S.whole_passages(table(spark, rows + odd)).collect()}
    check_spans(got, rows)
    text = {i: t.encode() for i, t in rows}
    for i in range(3, 30):
        at = text[i].index(shared[i % 3].encode())
        assert any(d == i and a <= at and a + n >= at + len(shared[i % 3]) for d, a, n in got)
    assert not {d for d, _, _ in got} & set(range(100, 120))
    check_spans({(r.doc_id, r.start, r.length) for r in S.whole_passages(table(spark, rows + rows)).collect()}, rows)
    assert S.whole_passages(table(spark, [])).collect() == []


def test_version_tells_texts_of_one_id_apart(spark):
    rows, _ = passage_rows()
    twice = [*rows[:4], (3, rows[30][1]), (3, rows[4][1])]  # doc_id 3 with three texts, of which the first and the last repeat a passage
    got = S.whole_passages(table(spark, twice)).collect()
    assert {r.doc_id for r in got} == {3} and len({r.version for r in got}) == 2
    texts = [r.text for r in S.without_repeats(table(spark, twice)).collect() if r.doc_id == 3]
    assert rows[30][1] in texts and len(texts) == 3


def test_cuts_resist_insertions():
    rng = random.Random(2)
    text = prose(rng, 2000).encode()
    moved = text[:500] + b"inserted words " + text[500:]
    chunks = lambda d: {d[a:b] for a, b in zip([0, *S.cuts(d).tolist()], S.cuts(d).tolist())}
    assert len(chunks(text) - chunks(moved)) <= 2
    assert S.cuts(text)[-1] == len(text) and max(b - a for a, b in zip([0, *S.cuts(b"a" * 999)], S.cuts(b"a" * 999))) <= S.MOST_BYTES
    assert S.cuts(b"x").tolist() == [1]


def test_without_repeats(spark):
    rows, shared = passage_rows()
    docs = table(spark, rows).withColumn("n_chars", F.length("text"))
    out = {r.doc_id: r for r in S.without_repeats(docs).collect()}
    assert len(out) == len(rows)
    for i, t in rows:
        assert out[i].n_chars == len(out[i].text)
        if i < 3 or 100 <= i < 120:
            assert out[i].text == t
        elif i < 30:
            left = shared[i % 3]
            assert left not in out[i].text and len(out[i].text) < len(t) - 150
    spans = {}
    for r in S.whole_passages(docs).orderBy("doc_id", "start").collect():
        spans.setdefault(r.doc_id, []).append((r.start, r.length))
    for i, t in rows:
        if i not in (202,):  # whole characters only
            data, at, keep = t.encode(), 0, b""
            for a, n in spans.get(i, []):
                keep, at = keep + data[at:a], a + n
            assert out[i].text == (keep + data[at:]).decode()
    odd = table(spark, [(None, "x"), (1, None), (2, "")])
    assert sorted(((r.doc_id, r.text) for r in S.without_repeats(odd).collect()), key=repr) == [(1, None), (2, ""), (None, "x")]


def whole_rows():
    """Passages of 51 words in two contexts each, those of few different words, and ones whose parts have other first holders."""
    rng = random.Random(12)
    rows = []
    for k in range(60):
        words = [rng.choice(WORDS) for _ in range(51)]
        words = [["ha"] * 51, ["a"] * 51, ["yes", "no"] * 26, ["x"] * 30 + words[:21]][k] if k < 4 else [w[:1] for w in words] if k < 8 else words
        shared = " ".join(words)
        if k % 5 == 4:  # most of it, without either end, is held by a document before them
            rows.append((3 * k, prose(rng, 20) + shared[10:-10][:90] + prose(rng, 20)))
        rows += [(3 * k + j, prose(rng, rng.randint(0, 30)) + " " + shared + " " + prose(rng, rng.randint(0, 30))) for j in (1, 2)]
    line = prose(rng, 40)[:85]
    rows += [(500 + i, prose(rng, 30) + line + prose(rng, 30)) for i in range(10)]  # shared, but too short
    return rows + [(600, "zz " + "ab " * 3000), (601, "ab " * 2000), (602, "é" * 5000), (603, "è" + "é" * 500), (604, "b" * 95), (605, "b" * 95)]


@pytest.mark.parametrize("batch", [2500, 40])
def test_whole_passages(spark, batch):
    rows, setting = whole_rows(), "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(batch))
    try:
        odd = [(700, None), (701, ""), (None, rows[0][1]), rows[5]]
        got = S.whole_passages(table(spark, rows + odd)).collect()
        found = {}
        for r in got:
            assert r.length >= S.MIN_BYTES
            found.setdefault(r.doc_id, set()).update(range(r.start, r.start + r.length))
        want = windows_held_before(rows)
        assert set(want) >= {3 * k + 2 for k in range(60)} and not set(want) & set(range(500, 510))
        assert found == want
        assert S.whole_passages(table(spark, [])).collect() == []
    finally:
        spark.conf.set(setting, before)


def test_every_window_holds_a_chunk():
    """Any ``MIN_BYTES`` bytes hold a whole chunk, and one that does not depend on what is around them."""
    rng = random.Random(8)
    for text in [prose(rng, 300), "yes no " * 90, "".join(rng.choice("ab") for _ in range(900))]:
        data = text.encode()
        ends = S.cuts(data).tolist()
        chunks = list(zip(ends[:-2], ends[1:-1]))
        for a in range(len(data) - S.MIN_BYTES + 1):
            assert any(a <= b and e <= a + S.MIN_BYTES for b, e in chunks)
    for _ in range(300):
        shared = prose(rng, 40)[: S.MIN_BYTES].encode()
        sets = []
        for _ in range(2):
            data = prose(rng, rng.randint(1, 20)).encode() + shared + prose(rng, rng.randint(1, 20)).encode()
            at, ends = data.index(shared), S.cuts(data).tolist()
            sets.append({(b - at, e - at) for b, e in zip(ends[:-2], ends[1:-1]) if at <= b and e <= at + S.MIN_BYTES})
        assert sets[0] & sets[1]
    for text in ("ha " * 200, "a" * 500, "yes no " * 90):  # cuts of one hash at equal distances are thinned out
        assert len(S.cuts(text.encode())) < len(text) / 15
