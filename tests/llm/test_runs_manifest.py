"""Run detection and the Merkle manifest against plain versions."""

import hashlib
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill.llm import merkle_manifest as M
from tidemill.llm import run_detection as R

# --- runs ----------------------------------------------------------------------------------------------


def plain_runs(words):
    """All maximal runs, by trying every period at every place."""
    found, n = {}, len(words)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)  # the smallest period comes first
            i = max(j, i) + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def some_words(rng):
    """Random words with planted repeats, some of them nested, over few or many different words."""
    kinds = rng.choice([2, 3, 6, 40])
    words = [b"w%d" % rng.randrange(kinds) for _ in range(rng.randrange(0, 60))]
    for _ in range(rng.randrange(0, 4)):
        unit = [b"w%d" % rng.randrange(kinds) for _ in range(rng.randrange(1, 12))]
        if rng.random() < 0.3:
            unit = unit * rng.randrange(2, 6) + [b"x"]
        at = rng.randrange(len(words) + 1)
        words[at:at] = (unit * rng.randrange(2, 9))[: rng.randrange(1, 90)]
    return words


def test_runs_equal_plain_ones():
    rng = random.Random(5)
    seen = 0
    for _ in range(3000):
        words = some_words(rng)
        want = plain_runs(words)
        assert R.runs_of(words) == want
        seen += len(want)
    assert seen > 1000


def test_segments_keep_every_run_and_shrink():
    rng = random.Random(6)
    for _ in range(300):
        words = some_words(rng)
        ids = np.array([int.from_bytes(w, "big") % 997 for w in words], dtype=np.int64)
        parts = R.segments(ids)
        for s, e in parts:
            assert e - s >= 6 and min(np.unique(ids[s:e], return_counts=True)[1]) >= 4
        for s, n, _ in plain_runs(ids.tolist()):
            assert any(a <= s and s + n <= b for a, b in parts)
    assert R.segments(np.zeros(0, dtype=np.int64)) == []


def test_long_periods_and_long_texts():
    rng = np.random.default_rng(1)
    unit = [b"u%d" % i for i in rng.integers(0, 50, 5000)]
    words = [b"a", b"b", *unit, *unit, *unit, *unit, *unit[:10], b"z"]
    assert (2, 20_010, 5000) in R.runs_of(words)
    assert R.runs_of([b"x"] * 200_000) == [(0, 200_000, 1)]
    assert R.runs_of([b"x"] * 5) == [] and R.runs_of([b"x"] * 6) == [(0, 6, 1)]
    assert R.runs_of([b"x", b"y"] * 4) == [(0, 8, 2)] and R.runs_of(([b"x", b"y"] * 4)[:-1]) == []


def test_strongest_and_collapse():
    assert R.strongest([]) is None
    assert R.strongest([(0, 8, 2), (9, 12, 3), (30, 4, 1)]) == (0, 8, 2)  # all have four turns
    big = 10**9
    assert R.strongest([(0, 4 * big, big), (5, 4 * big + 1, big)]) == (5, 4 * big + 1, big)
    words = [b"a", b"b", *[b"x", b"y"] * 5, b"c"]
    assert R.collapse(words, R.runs_of(words)) == b"a b x y c"
    assert R.collapse([], []) == b""


def test_find_runs_edges(spark):
    texts = {1: None, 2: "", 3: " \t\n", 4: "ha " * 7, 5: "the cat sat", 6: "Ü é " * 5 + "\x0bend", 7: "ha\x1f " * 6}
    rows = [(i, t, 1, "x", "y") for i, t in texts.items()] + [(4, "ha " * 7, 2, "x", "y"), (None, "no id no id no id no id", 3, "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, runs string, collapsed string")
    got = R.find_runs(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i in (1, 2, 3):
        assert (by[i].n_words, by[i].runs, by[i].strongest, by[i].collapsed) == (0, [], None, "")
    assert [tuple(r) for r in by[4].runs] == [(0, 7, 1)] and by[4].collapsed == "ha" and sum(r.doc_id == 4 for r in got) == 2
    assert by[5].runs == [] and by[5].collapsed == "the cat sat"
    assert tuple(by[6].strongest) == (0, 10, 2) and by[6].collapsed == "Ü é end"
    assert by[7].collapsed == "ha\x1f" and by[None].collapsed == "no id"
    assert R.find_runs(docs.limit(0)).collect() == []


# --- manifest ------------------------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_leaf(row, text):
    return sha("".join(map(plain_field, (row["doc_id"], row["source"], row["lang"], row["n_chars"], text))))


def plain_tree(nodes):
    """Root and, for each node, the (left, right) siblings on its way up."""
    paths, place = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(place):
            first = p // 8 * 8
            paths[i].append(("".join(nodes[first:p]), "".join(nodes[p + 1 : first + 8])))
        place = [p // 8 for p in place]
        nodes = [sha("".join(nodes[i : i + 8])) for i in range(0, len(nodes), 8)]
    return nodes[0], paths


def plain_manifest(rows, received):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row["lang"], []).append(row)
    tops, low = [], []
    for lang in sorted(by_lang, key=lambda x: (x is not None, (x or "").encode())):
        own = sorted(by_lang[lang], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r, r["text"])))
        top, paths = plain_tree([plain_leaf(r, r["text"]) for r in own])
        tops.append(top)
        low.append((own, paths))
    root, upper = plain_tree(tops)
    out = []
    for (own, paths), top, above in zip(low, tops, upper):
        for row, path in zip(own, paths):
            node = plain_leaf(row, received(row))
            for left, right in path + above:
                node = sha(left + node + right)
            out.append((row["doc_id"], plain_leaf(row, row["text"]), top, root, sha("".join(a + b for a, b in path + above)), node, node == root))
    return sorted(out, key=repr)


SHAPE = "doc_id long, text string, lang string, source string, n_chars long, leaf int, root string, grp int, at string, n int"


def some_rows(ids, langs, seed):
    rng = random.Random(seed)
    out = []
    for i in ids:
        text = rng.choice([None, "", "Some Text", "kein Ärger", "x" * rng.randrange(50)])
        lang, source = rng.choice(langs), rng.choice([None, "src1", "srcé"])
        out.append({"doc_id": i, "text": text, "lang": lang, "source": source, "n_chars": rng.choice([None, 3, -1]), "leaf": 1,
                    "root": "r", "grp": 2, "at": "a", "n": 7})
    return out


def check_manifest(spark, rows):
    docs = spark.createDataFrame([tuple(r.values()) for r in rows], SHAPE).repartition(3)
    received = F.when(F.col("doc_id") % 3 == 0, F.lower("text")).otherwise(F.col("text"))
    got = M.manifest(docs, received)
    want = plain_manifest(rows, lambda r: r["text"].lower() if r["text"] and r["doc_id"] is not None and r["doc_id"] % 3 == 0 else r["text"])
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=repr) == want
    return want


@pytest.mark.parametrize("n,langs", [(1, ["en"]), (8, ["en", None]), (9, ["en"]), (700, ["en", "en", "de", None, "é", "z", "Z", "", "fr", "es", "it"])])
def test_manifest(spark, n, langs):
    want = check_manifest(spark, some_rows(range(n), langs, n))
    assert any(w[-1] for w in want)


def test_manifest_of_scattered_ids(spark):
    """Ids far apart, negative, at both ends of the range; repeated and missing ids."""
    rng = random.Random(3)
    ids = [rng.randrange(-(2**63), 2**63) for _ in range(60)] + [rng.randrange(-300, 300) for _ in range(60)]
    ids += [2**63 - 1, -(2**63), 0, 63, 64, 65535, 65536] + [77] * 20 + [None] * 5
    check_manifest(spark, some_rows(ids, ["en", "de", None], 4))


def test_manifest_over_several_blocks(spark):
    """More than 8,192 leaves in one group: three blocks, a last one with few leaves, and a group that fills one block."""
    rows = some_rows(range(0, 3 * 8200, 3), ["en"], 8) + some_rows(range(1, 3 * 4096, 3), ["de"], 9)
    check_manifest(spark, rows)


def test_climb_through_two_rounds(spark):
    """Nodes of a level that fill more than one block, in two groups; sides and tops equal those of a plain tree."""
    nodes = {"=a": [sha(f"a{i}") for i in range(4100)], "=b": [sha(f"b{i}") for i in range(9)], "=c": [sha("c")]}
    table = [(g, i, len(some), bytes.fromhex(x)) for g, some in nodes.items() for i, x in enumerate(some)]
    df = spark.createDataFrame(table, "grp string, at long, n long, node binary").repartition(5)
    got = {(r.grp, r.at): r for r in M.climb(df, 4100).collect()}
    assert len(got) == len(table)
    for g, some in nodes.items():
        root, paths = plain_tree(some)
        for i, path in enumerate(paths):
            assert got[g, i].top.hex() == root and [tuple(x) for x in got[g, i].sides] == path


def test_manifest_of_nothing(spark):
    docs = spark.createDataFrame([], SHAPE)
    assert M.manifest(docs).collect() == []


def test_fraction_order_is_exact():
    runs = [(0, 7, 1), (9, 50, 7), (80, 43, 6)]
    assert R.strongest(runs) == max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
