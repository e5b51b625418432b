"""The queries of this folder's operators, one for each, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import Tables
from . import (
    exact_dedup,
    merkle_manifest,
    ngram_join,
    one_bit_search,
    packing,
    piece_scan,
    quality,
    revisits,
    run_detection,
    substring_dedup,
    token_counts,
    toxic_neighbours,
    url_filters,
)

JOBS = {}
SQL: dict[str, str] = {}


def job(fn):
    JOBS[fn.__name__] = fn
    return fn


@job
def op4_exact_dedup(t: Tables) -> DataFrame:
    """Every document with the one that stays of its group of equal texts."""
    return exact_dedup.exact_dedup(t.documents)


SQL["op4_exact_dedup"] = r"""
WITH t AS (
    SELECT doc_id, regexp_replace(coalesce(text, ''), '[ \t\n\x0B\f\r]+', ' ', 'g') AS body FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY body ORDER BY doc_id) = 1 AS kept, sha256(body) AS text_sha256
FROM t WINDOW w AS (PARTITION BY body)
"""


@job
def op6_token_counts(t: Tables) -> DataFrame:
    """Tokens of every document, and the bytes that fit 1024 tokens, read off the table of prefix counts."""
    counts = token_counts.prefix_counts(
        t.documents, public_tokenizers.path("byte_bpe_50k.json"), budget=1024, table=False
    )
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 1024).alias("over_limit"), "cut_bytes")


@job
def op9_packing(t: Tables) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(t.documents, public_tokenizers.path("word_bpe_49k.json"), window=2048, end_id=1)


@job
def op1_ngram_jaccard_join(t: Tables) -> DataFrame:
    """Classes of documents that links of Jaccard similarity 0.8 or more on five-word shingles form."""
    return ngram_join.near_components(t.documents, percent=80, width=5)


SQL["op1_ngram_jaccard_join"] = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0B\f\r]+') AS ws
    FROM documents
), s AS MATERIALIZED (
    SELECT DISTINCT doc_id, sha256(array_to_string(ws[i:i + 4], ' ')) AS sh
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), l AS MATERIALIZED (
    SELECT p.a, p.b FROM (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY 1, 2
    ) p JOIN n na ON na.doc_id = p.a JOIN n nb ON nb.doc_id = p.b WHERE 100 * p.c >= 80 * (na.n + nb.n - p.c)
), r(doc_id, other) AS (
    SELECT a, b FROM l UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.other
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.least_id, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id
LEFT JOIN (SELECT doc_id, min(other) AS least_id FROM r GROUP BY doc_id) m ON m.doc_id = d.doc_id
"""


@job
def op3_quality_classifier(t: Tables) -> DataFrame:
    """Quality score of every document, learned from preference pairs of labelled ones."""
    return quality.quality_scores(t.documents, t.labels)


@job
def op5_substring_dedup(t: Tables) -> DataFrame:
    """Passages of documents that occurred before."""
    return substring_dedup.whole_passages(t.documents).select("doc_id", "start", "length")


@job
def op7_one_bit_search(t: Tables) -> DataFrame:
    """The 20 nearest vectors, by inner product, of every vector whose id is divisible by 20."""
    return one_bit_search.nearest(t.embeddings, t.embeddings.where(F.col("vec_id") % 20 == 0), k=20)


SQL["op7_one_bit_search"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
      AND list_bool_or(list_transform(embedding, lambda x: x <> 0))
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_reduce(list_transform(list_zip(c.e, q.e), lambda p: p[1] * p[2]), lambda a, b: a + b) AS score
    FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 20
"""


@job
def op8_piece_scan(t: Tables) -> DataFrame:
    """SentencePiece ids of every document, and the digest of the text that they decode to."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    decoded = piece_scan.decode(piece_scan.encode(t.documents, path), path)
    return decoded.select("doc_id", "n_pieces", "ids_crc32", F.sha2("text", 256).alias("decoded_sha256"))


#: Four visits to each page: the first one full but for every eleventh page, later ones mostly not modified; every seventh page changes
#: at the third visit, and some visits send no entity tag. Times follow page_id, so visits to different pages interleave.
CAPTURES = """
SELECT page_id * 4 + k AS capture_id, url, 1700000000 + page_id * 60 + k * 500000 AS fetch_time,
       CASE WHEN (k = 0 AND page_id % 11 <> 0) OR (k = 2 AND page_id % 5 = 0) THEN 200 ELSE 304 END AS status,
       CASE WHEN (page_id + k) % 6 = 5 THEN NULL
            ELSE concat('"', md5(concat(url, CASE WHEN k >= 2 AND page_id % 7 = 0 THEN 'b' ELSE 'a' END)), '"') END AS etag,
       CASE WHEN k >= 2 AND page_id % 7 = 0 THEN 'Tue' ELSE 'Mon' END AS modified,
       concat('max-age=', CAST(k AS STRING)) AS cache, md5(html) AS digest
FROM visits
"""


@job
def op2_warc_revisits(t: Tables) -> DataFrame:
    """Visits to all pages, with not-modified ones resolved to the responses that they stand for."""
    visits = t.pages.select("page_id", "url", "html", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k"))
    rows = t.spark.sql(CAPTURES.replace("FROM visits", "FROM {visits}"), visits=visits)
    names = [F.lit(x) for x in ("ETag", "Last-Modified", "Cache-Control", "X-Payload")]
    headers = F.map_from_arrays(F.array(*names), F.array("etag", "modified", "cache", "digest"))
    sent = F.map_filter(headers, lambda k, v: v.isNotNull() & ((F.col("status") == 200) | (k != "X-Payload")))
    found = revisits.resolve(rows.withColumn("headers", sent))
    lines = F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit(": "), e["value"]))
    return found.select("capture_id", "url", "fetch_time", "outcome", "response_id", F.array_join(F.array_sort(lines), "\n").alias("headers"))


SQL["op2_warc_revisits"] = r"""
WITH visits AS (SELECT page_id, url, html, CAST(unnest(range(4)) AS INTEGER) AS k FROM pages), raw AS (
""" + CAPTURES + r"""
), parts AS (
    SELECT *, regexp_replace(trim(url), '#.*$', '') AS u FROM raw
), cut AS (
    SELECT *, regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1) AS scheme,
           regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?]*)', 1) AS host,
           regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?]*([^?]*)', 1) AS path, regexp_extract(u, '(\?.*)$', 1) AS query FROM parts
), named AS (
    SELECT capture_id, fetch_time, status, etag, modified, cache, digest,
           regexp_replace(lower(CASE WHEN lower(scheme) = 'https' THEN regexp_replace(host, ':443$', '') ELSE regexp_replace(host, ':80$', '') END), '^www\.', '')
           || regexp_replace(path, '/+$', '')
           || regexp_replace(regexp_replace(regexp_replace(regexp_replace(query, '([?&])(utm_[a-z]+|fbclid|gclid)=[^&]*', '\1', 'g'), '&+', '&', 'g'),
                             '\?&', '?', 'g'), '[?&]$', '') AS url
    FROM cut
), latest AS (
    SELECT *, max(CASE WHEN status = 200 THEN fetch_time * 1000000000 + capture_id END) OVER (
        PARTITION BY url ORDER BY fetch_time, capture_id) % 1000000000 AS found FROM named
), met AS (
    SELECT a.*, r.etag AS old_etag, r.modified AS old_modified, r.digest AS old_digest,
           CASE WHEN a.status = 200 THEN 'response' WHEN a.found IS NULL THEN 'no_response'
                WHEN a.etag IS NOT NULL THEN CASE WHEN coalesce(a.etag = r.etag, false) THEN 'resolved' ELSE 'mismatch' END
                WHEN a.modified = r.modified THEN 'resolved' ELSE 'mismatch' END AS outcome
    FROM latest a LEFT JOIN named r ON r.capture_id = a.found
)
SELECT capture_id, url, fetch_time, outcome,
       CASE outcome WHEN 'response' THEN capture_id WHEN 'resolved' THEN CAST(found AS BIGINT) END AS response_id,
       concat_ws(chr(10), 'cache-control: ' || cache,
           'etag: ' || CASE WHEN outcome = 'resolved' THEN coalesce(etag, old_etag) ELSE etag END,
           'last-modified: ' || CASE WHEN outcome = 'resolved' THEN old_modified ELSE modified END,
           'x-payload: ' || CASE WHEN status = 200 THEN digest WHEN outcome = 'resolved' THEN old_digest END) AS headers
FROM met
"""

#: List entries from pages: hosts and domains that are blocked and unblocked, and single paths that are allowed, by the day.
ENTRIES = r"""
SELECT page_id AS entry_id, list, action, (1700000000 + page_id * 600) // 86400 * 86400 AS entry_time,
       CASE WHEN list = 'allow' THEN host || path WHEN page_id % 50 = 12 THEN regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) ELSE host END AS pattern
FROM (
    SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)) AS host,
           regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/+$', '') AS path,
           CASE WHEN page_id % 50 = 11 THEN 'allow' ELSE 'block' END AS list,
           CASE WHEN page_id % 10 = 7 THEN 'remove' ELSE 'add' END AS action
    FROM pages WHERE page_id % 10 IN (3, 7) OR page_id % 50 IN (11, 12)
) q
"""


@job
def op10_url_filters(t: Tables) -> DataFrame:
    """Every page as a capture, evaluated against the list entries active at its fetch time."""
    entries = t.spark.sql(ENTRIES.replace("//", "DIV").replace(":DIV", "://").replace("FROM pages", "FROM {pages}"), pages=t.pages)
    captures = t.pages.select(F.col("page_id").alias("capture_id"), "url", (1700000000 + F.col("page_id") * 600).alias("fetch_time"))
    return url_filters.evaluate(captures, entries)


SQL["op10_url_filters"] = r"""
WITH entries AS (""" + ENTRIES + r"""), held AS (
    SELECT * FROM (
        SELECT list, pattern, action, entry_id, entry_time AS valid_from,
               lead(entry_time) OVER (PARTITION BY list, pattern ORDER BY entry_time, entry_id) AS valid_to
        FROM entries WHERE pattern <> ''
    ) WHERE action = 'add' AND (valid_to IS NULL OR valid_to > valid_from)
), c AS (
    SELECT page_id AS capture_id, 1700000000 + page_id * 600 AS at, lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)) AS host,
           regexp_replace(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/+$', '') AS path FROM pages
), active AS (
    SELECT c.capture_id, h.* FROM c JOIN held h ON h.valid_from <= c.at AND (h.valid_to IS NULL OR c.at < h.valid_to)
        AND (c.host = h.pattern OR ends_with(c.host, '.' || h.pattern) OR c.host || c.path = h.pattern OR starts_with(c.host || c.path, h.pattern || '/') AND contains(h.pattern, '/'))
), ranked AS (
    SELECT *, count(*) OVER (PARTITION BY capture_id) AS n_active,
           row_number() OVER (PARTITION BY capture_id ORDER BY length(pattern) DESC, (list = 'allow') DESC, list DESC, entry_id DESC) AS rn FROM active
)
SELECT c.capture_id, coalesce(r.list, 'none') AS decision, r.entry_id, r.pattern, coalesce(r.n_active, 0) AS n_active
FROM c LEFT JOIN ranked r ON r.capture_id = c.capture_id AND r.rn = 1
"""


@job
def op11_toxicity(t: Tables) -> DataFrame:
    """Toxicity score of every document from its nearest labelled examples."""
    return toxic_neighbours.toxicity(t.documents, t.labels)


#: h: unsigned crc32 of the decimal doc_id of every document, in DuckDB.
CRC_SQL = """
bit(n, k, c) AS (
    SELECT range, 0, range FROM range(256)
    UNION ALL SELECT n, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bit WHERE k < 8
), crc_table AS (SELECT list(c ORDER BY n) AS t FROM bit WHERE k = 8
), crc_step(doc_id, rest, c) AS (
    SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR), 4294967295 FROM documents WHERE doc_id IS NOT NULL
    UNION ALL SELECT doc_id, rest[2:], xor(c >> 8, t[1 + (xor(c, ascii(rest)) & 255)]) FROM crc_step, crc_table WHERE rest <> ''
), crc AS (SELECT doc_id, xor(c, 4294967295) AS h FROM crc_step WHERE rest = '')
"""


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """Every tenth document, by crc32 of its id, with its words from some place on as repeats of the first few there."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("long")
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n = F.size("words").cast("long")
    held = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("words"))
    placed = held.withColumn("a", F.when(n > 0, g % n)).withColumn("p", F.lit(1) + F.floor((n - F.col("a")) / (F.lit(3) + g % 8)).cast("long"))
    index = F.sequence(F.lit(0).cast("long"), n - 1)
    repeat = F.transform(index, lambda i: F.get("words", F.when(i >= F.col("a"), F.col("a") + (i - F.col("a")) % F.col("p")).otherwise(i).cast("int")))
    return placed.select("doc_id", F.when((F.col("h") % 10 == 0) & (n > 0), F.array_join(repeat, " ")).otherwise(F.col("text")).alias("text"))


@job
def op12_run_detection(t: Tables) -> DataFrame:
    """Runs of words that repeat with a period, in every document, and what is left when each is cut to one period."""
    found = run_detection.find_runs(with_planted_runs(t.documents))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    best = F.col("strongest")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * strongest.length DIV strongest.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


SQL["op12_run_detection"] = r"""
WITH RECURSIVE """ + CRC_SQL + r""", w AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS ws FROM documents
), g AS (
    SELECT w.doc_id, ws, len(ws) AS n, h, h // 10 AS g, CASE WHEN len(ws) > 0 THEN (h // 10) % len(ws) END AS a FROM w LEFT JOIN crc ON crc.doc_id = w.doc_id
), p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM g
), x AS MATERIALIZED (
    SELECT doc_id, n, i, ws[1 + CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END] AS word
    FROM (SELECT *, unnest(range(n)) AS i FROM p)
), pairs AS (
    SELECT l.doc_id, l.i, r.i - l.i AS q FROM x l JOIN x r ON r.doc_id = l.doc_id AND r.word = l.word AND r.i > l.i AND 4 * (r.i - l.i) <= l.n
), stretch AS (
    SELECT doc_id, q, min(i) AS start, count(*) + q AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs) GROUP BY doc_id, q, island
    HAVING count(*) + q >= greatest(6, 4 * q)
), runs AS MATERIALIZED (SELECT doc_id, start, length, min(q) AS period FROM stretch GROUP BY doc_id, start, length
), dropped AS (
    SELECT DISTINCT x.doc_id, x.i FROM x JOIN runs r ON r.doc_id = x.doc_id AND x.i >= r.start + r.period AND x.i < r.start + r.length
), left_over AS (
    SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.i) AS body FROM x ANTI JOIN dropped d ON d.doc_id = x.doc_id AND d.i = x.i GROUP BY x.doc_id
), listed AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS body FROM runs GROUP BY doc_id
), best AS (
    SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) = 1
)
SELECT d.doc_id, coalesce(l.n_runs, 0) AS n_runs, b.start, b.length, b.period, 1000 * b.length // b.period AS exponent_milli,
       sha256(coalesce(l.body, '')) AS runs_sha256, sha256(coalesce(o.body, '')) AS collapsed_sha256
FROM documents d LEFT JOIN listed l ON l.doc_id = d.doc_id LEFT JOIN best b ON b.doc_id = d.doc_id LEFT JOIN left_over o ON o.doc_id = d.doc_id
"""


@job
def op13_merkle_manifest(t: Tables) -> DataFrame:
    """Every document's leaf and proof in the tree over all documents, and whether the text that was received verifies."""
    capitals = "".join(map(chr, range(65, 91)))
    changed = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    received = F.when(changed, F.translate("text", capitals, capitals.lower())).otherwise(F.col("text"))
    return merkle_manifest.manifest(t.documents, received)


def _tree_sql(name: str, source: str, levels: int) -> str:
    """CTEs of a tree over ``source`` (g, pos, node, n), 8 to 1: {name}0 to {name}{levels} with each node's siblings."""
    out = f"{name}0 AS MATERIALIZED (SELECT g, pos, node, n FROM {source})"
    for i in range(levels):
        out += f""", {name}s{i} AS MATERIALIZED (
            SELECT g, pos, n, coalesce(string_agg(node, '') OVER (PARTITION BY g, pos // 8 ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                   coalesce(string_agg(node, '') OVER (PARTITION BY g, pos // 8 ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{i}
        ), {name}{i + 1} AS MATERIALIZED (
            SELECT g, pos // 8 AS pos, CASE WHEN any_value(n) = 1 THEN any_value(node) ELSE sha256(string_agg(node, '' ORDER BY pos)) END AS node, (any_value(n) + 7) // 8 AS n
            FROM {name}{i} GROUP BY g, pos // 8
        )"""
    return out


def _fold_sql(name: str, source: str, levels: int, g: str, pos: str) -> str:
    """CTEs that take ``source`` (node, path, and the rest) up the tree ``name``, ending in {name}f{levels}."""
    out = f"{name}f0 AS (SELECT * FROM {source})"
    for i in range(levels):
        out += f""", {name}f{i + 1} AS (
            SELECT f.* REPLACE (CASE WHEN s.n = 1 THEN f.node ELSE sha256(s.l || f.node || s.r) END AS node, CASE WHEN s.n = 1 THEN path ELSE path || s.l || s.r END AS path)
            FROM {name}f{i} f JOIN {name}s{i} s ON s.g = f.{g} AND s.pos = f.{pos} // {8 ** i}
        )"""
    return out


def _field_sql(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen(CAST({x} AS VARCHAR)) || ':' || {x} END"


_HEAD = " || ".join(map(_field_sql, ("doc_id", "source", "lang", "n_chars")))
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL["op13_merkle_manifest"] = f"""
WITH RECURSIVE {CRC_SQL}, leaves AS MATERIALIZED (
    SELECT d.doc_id, CASE WHEN lang IS NULL THEN '' ELSE '=' || lang END AS g, sha256({_HEAD} || {_field_sql("text")}) AS node,
           sha256({_HEAD} || CASE WHEN h % 3 = 0 THEN {_field_sql(_LOWER)} ELSE {_field_sql("text")} END) AS seen
    FROM documents d LEFT JOIN crc USING (doc_id)
), placed AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, node) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaves
), {_tree_sql("low", "placed", 7)}, tops AS (
    SELECT 'all' AS g, g AS grp, row_number() OVER (ORDER BY g) - 1 AS pos, node, count(*) OVER () AS n FROM low7
), {_tree_sql("up", "tops", 3)}, start AS (
    SELECT p.doc_id, p.node AS leaf, p.seen AS node, '' AS path, p.g, p.pos, 'all' AS every, t.pos AS group_at, t.node AS subroot
    FROM placed p JOIN tops t ON t.grp = p.g
), {_fold_sql("low", "start", 7, "g", "pos")}, {_fold_sql("up", "lowf7", 3, "every", "group_at")}
SELECT doc_id, leaf, subroot, up3.node AS root, sha256(path) AS proof_sha256, upf3.node AS folded_root, upf3.node = up3.node AS verified FROM upf3, up3
"""
