"""The operators' queries on the smallest tables: against SQL, the libraries or plain versions; and the pipeline."""

import zlib

import numpy as np
import public_tokenizers as P
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from tidemill.llm import queries
from tools.check import compare, connect

BASE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(BASE)


@pytest.fixture(scope="module")
def texts(db):
    return dict(db.execute("select doc_id, text from documents").fetchall())


@pytest.mark.parametrize("name", list(queries.SQL))
def test_against_sql(spark, db, name):
    df = entry.queries()[name](spark, BASE)
    rows = [tuple(r) for r in df.collect()]
    cur = db.execute(queries.SQL[name])
    assert rows and compare(df.columns, rows, [d[0] for d in cur.description], cur.fetchall()) is None


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.JOBS) == list(range(1, 14))
    assert set(queries.JOBS) | {"pipeline"} <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_token_counts(spark, texts):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for r in entry.queries()["op6_token_counts"](spark, BASE).collect():
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_tokens, r.over_limit, r.n_bytes) == (n, n > 1024, len(texts[r.doc_id].encode()))


def test_piece_scan(spark, texts):
    import hashlib

    library = SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    for r in entry.queries()["op8_piece_scan"](spark, BASE).collect():
        ids = library.encode(texts[r.doc_id])
        assert (r.n_pieces, r.ids_crc32) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def check_packed(rows, texts):
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in texts.items()}
    seen = dict.fromkeys(ids, 0)
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == seen[r.doc_id] and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes())
        seen[r.doc_id] += r.length
    assert seen == {i: len(x) for i, x in ids.items()}
    fill = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fill.get(r.sequence_id, 0)
        fill[r.sequence_id] = r.offset + r.length
    assert max(fill.values()) <= 2048
    return fill


def test_packing(spark, texts):
    fill = check_packed(entry.queries()["op9_packing"](spark, BASE).collect(), texts)
    assert sum(n < 2048 for n in fill.values()) <= 8


def test_pipeline(spark, texts, db, tmp_path):
    """Each stage against a plain version on what the stage before it kept."""
    from tests.llm.test_duplicates import plain_components, plain_groups, windows_held_before

    docs, outs = spark.read.parquet(f"{BASE}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, BASE).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert docs.columns == columns
            outs[name] = {r.doc_id: r.text for r in docs.collect()}
    good = outs["quality_classifier"]
    labels = dict(db.execute("select doc_id, quality from labels").fetchall())
    assert all(texts[i] == t for i, t in good.items()) and np.mean([(i in good) == bool(q) for i, q in labels.items()]) > 0.95
    unique = outs["exact_dedup"]
    assert set(unique) == {k for i, k, _, _ in plain_groups(list(good.items())) if i == k}
    apart = outs["ngram_jaccard_join"]
    assert set(apart) == {i for i, _, c in plain_components(list(unique.items())) if i == c}
    cut, held = outs["substring_dedup"], windows_held_before(list(apart.items()))
    assert set(cut) == set(apart)
    for i, t in apart.items():
        less = len(t.encode()) - len(cut[i].encode())
        # nothing but what an earlier document holds goes, and of it all but a few bytes at the ends of passages
        assert 0 <= less <= len(held.get(i, ())) and less >= 0.9 * len(held.get(i, ())) - 12
    check_packed(docs.collect(), cut)
    again = corpus_pipeline.run(spark, BASE).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, docs.collect()))
