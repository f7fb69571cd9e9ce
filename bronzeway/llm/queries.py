"""The registered queries of the operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bronzeway.llm import (
    decontam,
    html,
    jaccard,
    licences,
    merkle,
    mixing,
    negatives,
    quality,
    spans,
    spm,
    suffixes,
    urls,
    warc,
)
from bronzeway.llm.common import ready, stored
from bronzeway.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(make: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return make(ready(spark), sf_dir)

    QUERIES[make.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


# --- 2 -----------------------------------------------------------------------

URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query
def op2_url_filter(spark, sf):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    pages = table(spark, sf, "pages").select("page_id", "url")
    return urls.filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


ORACLES["op2_url_filter"] = """
WITH rules(rhost, rpath, action) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
cut AS (SELECT page_id, url,
    CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (SELECT row_number() OVER () AS n, page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
best AS (SELECT n, arg_max(rhost || rpath, length(rhost || rpath)) AS rule,
    arg_max(action, length(rhost || rpath)) AS action
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  GROUP BY n)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM parts LEFT JOIN best USING (n)
"""


# --- 9 -----------------------------------------------------------------------


def encoded_digest(docs: DataFrame) -> DataFrame:
    """Counts, flags and a digest of the ids, which stay on the executors."""
    rows = spm.encode(docs.select("doc_id", "text"), spm.read_model())
    return rows.select(
        "doc_id",
        F.size("ids").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", "ids"), 256).alias("ids_sha256"),
        (F.col("decoded") == F.col("text")).alias("round_trip"),
        "parity",
    )


@query
def op9_sentencepiece(spark, sf):
    return encoded_digest(table(spark, sf, "documents"))


# --- 10 ----------------------------------------------------------------------


@query
def op10_quality(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    return quality.measure(docs).drop("text", "lang")


# --- 6 -----------------------------------------------------------------------


@query
def op6_warc(spark, sf):
    planned = warc.plan_records(table(spark, sf, "pages"))
    archives = stored(warc.normalise(warc.write_monolithic(planned)), "warc")
    return warc.read_records(archives, payload=False).drop("url")


ORACLES["op6_warc"] = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
    sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to
FROM m
"""


# --- 8 -----------------------------------------------------------------------


@query
def op8_jaccard_join(spark, sf):
    return jaccard.link_components(table(spark, sf, "documents"), n=4, percent=85)


ORACLES["op8_jaccard_join"] = r"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT r, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END)) AS g FROM w),
h AS (SELECT r, hash(g) AS g FROM s),
n AS (SELECT r, count(*) AS n FROM h GROUP BY r),
p AS (SELECT a.r AS x, b.r AS y, count(*) AS k FROM h a JOIN h b ON a.g = b.g AND a.r < b.r GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n na ON na.r = x JOIN n nb ON nb.r = y
  WHERE 100 * k >= 85 * (na.n + nb.n - k)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
c(r, o) AS (SELECT r, r FROM w UNION SELECT c.r, e.y FROM c JOIN e ON e.x = c.o)
SELECT w.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(v.doc_id) AS component_id
FROM w JOIN c ON c.r = w.r JOIN w v ON v.r = c.o LEFT JOIN n ON n.r = w.r
GROUP BY w.r, w.doc_id
"""


# --- 4 -----------------------------------------------------------------------


@query
def op4_suffix_array(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return suffixes.remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )


# --- 1 -----------------------------------------------------------------------


@query
def op1_sentence_spans(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return spans.remove_repeated_spans(docs).select(
        "doc_id", "n_sentences", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), "kept"
    )


# --- 5 -----------------------------------------------------------------------


@query
def op5_decontamination(spark, sf):
    return decontam.matches(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


# --- 3 -----------------------------------------------------------------------


@query
def op3_html_text(spark, sf):
    return html.extract_text(table(spark, sf, "pages")).select("page_id", "url", "text", "n_chars")


# --- 7 -----------------------------------------------------------------------


@query
def op7_licence_scan(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scanned = licences.scan(docs, licences.train(docs))
    return scanned.select(
        "doc_id",
        F.size("licences").alias("n_licences"),
        F.array_join(F.array_sort(F.array_distinct("licences.family")), " ").alias("families"),
        "licences",
    )


# --- 11 ----------------------------------------------------------------------


def tampered_manifest(docs: DataFrame) -> DataFrame:
    """Proofs of all rows, held against leaves some of which were tampered with."""
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    changed = [F.col("n_chars") + 1 if c == "n_chars" else F.col(c) for c in docs.select(*fields).columns]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    seen = F.when(hit, merkle.leaf_digest(*changed)).alias("seen")
    rows = merkle.manifest(docs, merkle.leaf_digest(*fields), carry=[seen])
    seen = F.coalesce("seen", "leaf")
    return rows.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
        merkle.folded(seen, F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


@query
def op11_merkle_manifest(spark, sf):
    return tampered_manifest(table(spark, sf, "documents"))


def _crc32(text: str) -> str:
    """CRC-32 of ASCII text, bit by bit."""
    step = "xor(c, x)"
    bits = "list_reduce(list_prepend({0}, [0, 0, 0, 0, 0, 0, 0, 0]), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)"
    return (
        "xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, "
        f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)), "
        f"lambda c, x: {bits.format(step)}))"
    )


def _leaf_sql(n_chars: str) -> str:
    fields = ("doc_id", "source", "lang", n_chars, "text")
    parts = (f"coalesce(strlen(({f})::VARCHAR) || ':' || ({f})::VARCHAR, '-')" for f in fields)
    return f"sha256({' || '.join(parts)})"


ORACLES["op11_merkle_manifest"] = f"""
WITH RECURSIVE l AS (SELECT doc_id, lang, {_leaf_sql("n_chars")} AS h,
    CASE WHEN {_crc32("doc_id::VARCHAR")} % 7 = 0 THEN {_leaf_sql("n_chars + 1")} END AS seen
  FROM documents),
p AS (SELECT doc_id, h, coalesce(seen, h) AS seen, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS t,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n FROM l),
g(t, k, pos, h, n) AS (SELECT t, 0, pos, h, n FROM p
  UNION ALL SELECT t, k + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2
  FROM g WHERE n > 1 GROUP BY t, k, pos // 2, n),
s AS (SELECT t, k AS depth, h FROM g WHERE n = 1),
u(k, pos, h, n) AS (SELECT 0, t, h, count(*) OVER () FROM s
  UNION ALL SELECT k + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2
  FROM u WHERE n > 1 GROUP BY k, pos // 2, n),
w(doc_id, h, t, k, pos, seen, proof) AS (
  SELECT doc_id, h, t, 0, pos, seen, '' FROM p
  UNION ALL SELECT w.doc_id, w.h, w.t, w.k + 1, w.pos // 2,
    CASE WHEN g.h IS NULL THEN sha256(w.seen) WHEN w.pos % 2 = 0 THEN sha256(w.seen || g.h) ELSE sha256(g.h || w.seen) END,
    w.proof || coalesce(g.h, '')
  FROM w JOIN s ON s.t = w.t AND w.k < s.depth
    LEFT JOIN g ON g.t = w.t AND g.k = w.k AND g.pos = xor(w.pos, 1)),
v(doc_id, h, t, k, pos, seen, proof) AS (
  SELECT w.doc_id, w.h, w.t, 0, w.t, w.seen, w.proof FROM w JOIN s ON s.t = w.t AND w.k = s.depth
  UNION ALL SELECT v.doc_id, v.h, v.t, v.k + 1, v.pos // 2,
    CASE WHEN u.h IS NULL THEN sha256(v.seen) WHEN v.pos % 2 = 0 THEN sha256(v.seen || u.h) ELSE sha256(u.h || v.seen) END,
    v.proof || coalesce(u.h, '')
  FROM v LEFT JOIN u ON u.k = v.k AND u.pos = xor(v.pos, 1)
  WHERE v.k < (SELECT max(k) FROM u))
SELECT v.doc_id, v.h AS leaf, s.h AS subroot, r.h AS root, sha256(v.proof) AS proof_sha256,
  v.seen AS folded_root, v.seen = r.h AS verified
FROM v JOIN s ON s.t = v.t, (SELECT h FROM u WHERE n = 1) r WHERE v.k = (SELECT max(k) FROM u)
"""


# --- 12 ----------------------------------------------------------------------


@query
def op12_hard_negatives(spark, sf):
    vectors = table(spark, sf, "embeddings").select("vec_id", "embedding", "label")
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0, noisy)


ORACLES["op12_hard_negatives"] = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
    list_inner_product(a.v::DOUBLE[], b.v::DOUBLE[])::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, positive_id, (row_number() OVER w)::INT AS rank, other AS negative_id,
  positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other)
QUALIFY row_number() OVER w <= 3
"""


# --- 13 ----------------------------------------------------------------------


@query
def op13_source_mix(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken", "source", "copies")
