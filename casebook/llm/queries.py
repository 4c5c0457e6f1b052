"""Registered queries of this subpackage: each operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.llm import collocations, decontaminate, exact_dedup, hard_negatives, jaccard_join, language_id, line_dedup, packing, pseudonyms, quality, secret_scan, suffix_dedup, warc
from casebook.llm.frames import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
PSEUDONYM_KEY = "catalogue key"  # of the registered query only; a job passes its own
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(spark, f"{sf_dir}/documents.parquet").drop("keep_file", "keep_row")


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.learn(docs))


@query
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


@query
def op7_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymise(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(table(spark, sf_dir, "documents"))


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.classify(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


@query
def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=90)


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, label=label)


@query
def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    row_id = F.concat_ws(":", F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    return warc.digest(spark, table(spark, sf_dir, "pages"), row_id=row_id)


ORACLES["op1_line_dedup"] = """
WITH l AS (
  SELECT doc_id, unnest(range(len(x))) AS pos, unnest(x) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)),
w AS (
  SELECT *, CASE WHEN trim(line) = '' THEN 0 ELSE length(line) - length(replace(line, ' ', '')) + 1 END AS words FROM l),
c AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY pos) AS ends FROM w),
m AS (
  SELECT a.doc_id, a.pos AS start, b.pos AS last
  FROM c a JOIN c b ON a.doc_id = b.doc_id AND b.pos >= a.pos
   AND b.ends - a.ends + a.words >= 8
   AND (b.pos = a.pos OR b.ends - b.words - a.ends + a.words < 8 OR b.ends - a.ends < 8)),
r AS (
  SELECT m.doc_id, m.start, m.last, list(c.line ORDER BY c.pos) AS run
  FROM m JOIN c ON c.doc_id = m.doc_id AND c.pos BETWEEN m.start AND m.last GROUP BY ALL),
f AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY doc_id, start) AS n FROM r),
g AS (SELECT DISTINCT c.doc_id, c.pos FROM f JOIN c ON c.doc_id = f.doc_id AND c.pos BETWEEN f.start AND f.last WHERE n > 1)
SELECT c.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed,
  sha256(coalesce(string_agg(CASE WHEN g.pos IS NULL THEN c.line END, chr(10) ORDER BY c.pos), '')) AS kept_sha256
FROM c LEFT JOIN g ON g.doc_id = c.doc_id AND g.pos = c.pos GROUP BY c.doc_id
"""

ORACLES["op2_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER t AS keep_id, count(*) OVER t AS group_size,
  doc_id = max(doc_id) OVER t AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW t AS (PARTITION BY coalesce(text, ''))
"""

ORACLES["op3_suffix_dedup"] = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS x FROM documents),
p AS (SELECT doc_id, unnest(range(0, octet_length(x) - 99)) AS pos, x FROM d WHERE octet_length(x) >= 100),
g AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY array_slice(x, pos + 1, pos + 100) ORDER BY doc_id, pos) AS n FROM p),
e AS (
  SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM g WHERE n > 1),
s AS (SELECT doc_id, pos, sum(CASE WHEN before IS NULL OR pos > before + 100 THEN 1 ELSE 0 END)
  OVER (PARTITION BY doc_id ORDER BY pos) AS span FROM e),
r AS (SELECT doc_id, span, min(pos) AS lo, max(pos) + 100 AS hi FROM s GROUP BY doc_id, span),
k AS (
  SELECT doc_id, count(*) AS n_spans, sum(hi - lo) AS n_removed, list(lo ORDER BY lo) AS los, list(hi ORDER BY lo) AS his
  FROM r GROUP BY doc_id)
SELECT d.doc_id, CAST(octet_length(x) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(CASE WHEN los IS NULL THEN x ELSE unhex(array_to_string(list_transform(range(0, len(los) + 1), lambda i:
    CASE WHEN i = 0 AND los[1] = 0 OR i = len(los) AND his[i] = octet_length(x) THEN ''
      ELSE hex(array_slice(x, CASE WHEN i = 0 THEN 1 ELSE his[i] + 1 END, CASE WHEN i = len(los) THEN octet_length(x) ELSE los[i + 1] END)) END), '')) END)
    AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""


def _secrets_sql() -> str:
    parts = []
    for k, r in enumerate(secret_scan.RULES):
        p = "'" + r.pattern.replace("'", "''") + "'"
        parts.append(
            f"SELECT doc_id, {k} AS k, '{r.name}' AS kind, {str(r.base).upper()} AS base, string_split_regex(t, {p}) AS gaps, regexp_extract_all(t, {p}, 0) AS hits, "
            f"regexp_extract_all(t, {p}, {r.group}) AS parts, {r.least} AS least FROM d WHERE regexp_matches(t, {p})"
        )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({' UNION ALL '.join(parts)}),
i AS (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM m),
s AS (
  SELECT doc_id, k, kind, base, length(array_to_string(gaps[1:i], '')) + length(array_to_string(hits[1:i - 1], '')) AS a, length(hits[i]) AS n
  FROM i WHERE length(parts[i]) >= least)
SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, k) FILTER (base), '')) AS base_sha256,
  coalesce(string_agg(kind || ':' || a || ':' || (a + n), ',' ORDER BY a, k) FILTER (kind IS NOT NULL), '') AS spans
FROM d LEFT JOIN s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""


ORACLES["op8_secret_scan"] = _secrets_sql()

ORACLES["op10_jaccard_join"] = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
b AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS m FROM g x JOIN g y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT b.a, b.b FROM b JOIN n na ON na.doc_id = b.a JOIN n nb ON nb.doc_id = b.b WHERE 100 * b.m >= 90 * (na.n + nb.n - b.m)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT a AS doc_id, a AS c FROM e UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.c, w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) m ON m.doc_id = w.doc_id
"""

ORACLES["op11_collocations"] = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g FROM w, (SELECT unnest(range(1, 5)) AS k)),
f AS (SELECT lang, g, count(*) AS f FROM g GROUP BY ALL),
c AS (SELECT * FROM f WHERE len(g) >= 2 AND f >= 30),
k AS (SELECT *, unnest(range(1, len(g))) AS k FROM c),
s AS (
  SELECT k.lang, k.g, k.f AS a, l.f AS l, r.f AS r, CAST(CAST(2000000 AS HUGEINT) * k.f // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score
  FROM k JOIN f l ON l.lang = k.lang AND l.g = k.g[1:k.k] JOIN f r ON r.lang = k.lang AND r.g = k.g[k.k + 1:]
  QUALIFY row_number() OVER (PARTITION BY k.lang, k.g ORDER BY score, k.k) = 1),
i AS (SELECT lang, f, g, unnest(range(1, len(g))) AS i FROM c),
j AS (SELECT lang, f, g, i, unnest(range(2, len(g))) AS m FROM i),
x AS (SELECT lang, g[i:i + m - 1] AS g, max(f) AS f FROM j WHERE i + m - 1 <= len(g) GROUP BY ALL)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, array_to_string(s.g, ' ')) AS rank, array_to_string(s.g, ' ') AS phrase,
  a, l, r, n, score
FROM s JOIN t ON t.lang = s.lang LEFT JOIN x ON x.lang = s.lang AND x.g = s.g
WHERE x.f IS NULL OR CAST(100 AS HUGEINT) * x.f < CAST(80 AS HUGEINT) * a QUALIFY rank <= 2000
"""

ORACLES["op12_hard_negatives"] = """
WITH e AS (
  SELECT row_number() OVER () AS u, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.u AS au, a.vec_id AS anchor_id, b.u AS bu, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.u <> b.u),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY au ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.au, p.bu ORDER BY s.score DESC, s.vec_id) AS INT) AS rank,
  s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.au = p.au AND NOT s.same AND 80 * p.score <= 100 * s.score AND s.score <= p.score
QUALIFY rank <= 5
"""

ORACLES["op13_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS x FROM pages),
d AS (
  SELECT page_id, x, list_transform(range(4), lambda k: CAST('0x' || substr(sha1(x), CAST(10 * k + 1 AS INT), 10) AS BIGINT)) AS fives, max(page_id) OVER (PARTITION BY x) AS first FROM p)
SELECT page_id, CAST(octet_length(x) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((fives[i // 8 + 1] >> (35 - 5 * (i % 8))) & 31 AS INT) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""
