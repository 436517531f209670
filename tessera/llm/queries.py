"""The thin ``opN_*`` queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontam, divergence, embed_lsh, html_extract, line_dedup, link_graph, ngram_join, packing, quality, secret_scan, vector_codes, winnow
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_lsh.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.edit_trial(table(spark, sf_dir, "documents"))


@query
def op3_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)
    return pieces


@query
def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_documents(table(spark, sf_dir, "documents"))


@query
def op8_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(table(spark, sf_dir, "documents"))


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.report(table(spark, sf_dir, "documents"))


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"))


@query
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_graph.judge(table(spark, sf_dir, "pages"))


@query
def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


_REACH = """
  reach(id, c) AS (SELECT {id}, {id} FROM {table} UNION SELECT r.id, l.b FROM reach r JOIN link l ON l.a = r.c),
  low AS (SELECT id, min(c) AS component_id FROM reach GROUP BY id)"""

ORACLE_SQL["op1_embedding_near_dedup"] = f"""
WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
  link AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id
           WHERE list_cosine_similarity(x.e, y.e) >= 0.93),{_REACH.format(id="vec_id", table="embeddings")}
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN low ON id = vec_id LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY a) k ON a = vec_id"""

ORACLE_SQL["op7_ngram_jaccard_join"] = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w FROM documents),
  s AS (SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
                                   WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM words),
  n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
  link AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
                             GROUP BY 1, 2) p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
           WHERE 100 * i >= 75 * (na.n + nb.n - i)),{_REACH.format(id="doc_id", table="documents")}
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM documents JOIN low ON id = doc_id LEFT JOIN n USING (doc_id)"""


@query
def op11_source_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


@query
def op12_vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


@query
def op13_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE_SQL["op11_source_divergence_audit"] = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
  kept AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM d) GROUP BY 1, 2 HAVING count(*) >= 3),
  n AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(w) AS term FROM d) JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
  v AS (SELECT lang, count(*) AS v FROM kept GROUP BY 1),
  g AS (SELECT DISTINCT lang, source FROM d),
  total AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN n USING (lang, source) GROUP BY 1, 2),
  p AS (SELECT g.lang, g.source, k.term, coalesce(n.n, 0) AS n,
          CAST(1 + (1000000000::HUGEINT * (coalesce(n.n, 0) + 1)) // (t.total + v.v) AS BIGINT) AS p
        FROM g JOIN kept k ON k.lang = g.lang JOIN v ON v.lang = g.lang JOIN total t ON t.lang = g.lang AND t.source = g.source
        LEFT JOIN n ON n.lang = g.lang AND n.source = g.source AND n.term = k.term),
  q AS (SELECT k.lang, k.term, CAST(1 + (1000000000::HUGEINT * (s.n + 1)) // (t.total + v.v) AS BIGINT) AS q
        FROM kept k JOIN v USING (lang) JOIN (SELECT lang, term, sum(n) AS n FROM n GROUP BY 1, 2) s ON s.lang = k.lang AND s.term = k.term
        JOIN (SELECT lang, sum(n) AS total FROM n GROUP BY 1) t ON t.lang = k.lang),
  pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
           FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
           LEFT JOIN (SELECT x.lang, x.source, y.source AS peer, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS value
                      FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY 1, 2, 3) s
             ON s.lang = a.lang AND s.source = a.source AND s.peer = b.source),
  term AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, CAST(((p.p - q.q) * (p.p - q.q)) // q.q AS BIGINT) AS value
           FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
               FROM (SELECT * FROM pair UNION ALL SELECT * FROM term)) WHERE part = 'pair' OR rank <= 200"""

ORACLE_SQL["op13_benchmark_decontamination"] = r"""
WITH words AS MATERIALIZED (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
  item_words AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
  windows AS (SELECT DISTINCT item_id, len, array_to_string(w[i:i + len - 1], ' ') AS g FROM (
    SELECT item_id, w, least(10, len(w)) AS len, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM item_words WHERE len(w) > 0)),
  grams AS (SELECT row, len, i, array_to_string(w[i:i + len - 1], ' ') AS g FROM (
    SELECT row, w, len, unnest(range(1, len(w) - len + 2)) AS i FROM words, (SELECT DISTINCT len FROM windows) WHERE len(w) >= len)),
  found AS (SELECT row, i, len, item_id FROM grams JOIN windows USING (len, g)),
  common AS (SELECT term, count(*) AS n FROM (SELECT unnest(w) AS term FROM words) GROUP BY term),
  rarest AS (SELECT item_id, terms, arg_min(term, struct_pack(n := coalesce(n, 0), t := term)) AS term
             FROM (SELECT item_id, g, list_distinct(string_split(g, ' ')) AS terms, unnest(list_distinct(string_split(g, ' '))) AS term FROM windows)
             LEFT JOIN common USING (term) GROUP BY item_id, g, terms),
  near AS (SELECT DISTINCT row, item_id FROM (SELECT row, w, i, w[i] AS term FROM (SELECT row, w, unnest(range(1, len(w) + 1)) AS i FROM words)) JOIN rarest USING (term)
           WHERE list_has_all(w[greatest(1, i - 14):i + 14], terms) AND len(list_filter(range(0, 15), lambda o: list_has_all(w[greatest(1, i - o):i - o + 14], terms))) > 0),
  hit AS (SELECT row, count(DISTINCT k) AS n_hit FROM (SELECT row, unnest(range(i, i + len)) AS k FROM (SELECT DISTINCT row, i, len FROM found)) GROUP BY row),
  items AS (SELECT row, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT row, item_id FROM found) GROUP BY row),
  close AS (SELECT row, count(*) AS n_near FROM near GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
FROM words LEFT JOIN hit USING (row) LEFT JOIN items USING (row) LEFT JOIN close USING (row)"""

_NEAREST = """
  a{k} AS (SELECT vec_id, label, part, x, min(list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) * 64 + entry) AS best
           FROM p JOIN c{k} USING (part) GROUP BY vec_id, label, part, x)"""
_MOVED = """
  m{k} AS (SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM (
      SELECT part, best % 64 AS entry, i, CAST(sum(x[i]) AS HUGEINT) AS s, count(*) AS n FROM a{k}, (SELECT unnest(range(1, 1 + (SELECT max(len(x)) FROM p))) AS i) GROUP BY 1, 2, 3)
    GROUP BY part, entry),
  c{j} AS (SELECT part, entry, coalesce(m.c, o.c) AS c FROM c{k} o LEFT JOIN m{k} m USING (part, entry))"""
ORACLE_SQL["op12_vector_code_compression"] = f"""
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  p AS MATERIALIZED (SELECT vec_id, label, part, e[part * len(e) // 16 + 1:(part + 1) * len(e) // 16] AS x FROM (SELECT *, unnest(range(0, 16)) AS part FROM v)),
  c0 AS MATERIALIZED (SELECT part, r - 1 AS entry, x AS c FROM (SELECT part, x, row_number() OVER (PARTITION BY part ORDER BY vec_id) AS r FROM p) WHERE r <= 64),{_NEAREST.format(k=0)},{
  _MOVED.format(k=0, j=1)},{_NEAREST.format(k=1)},{_MOVED.format(k=1, j=2)},{_NEAREST.format(k=2)},
  coded AS (SELECT vec_id, label, string_agg(printf('%02x', best % 64), '' ORDER BY part) AS code, CAST(sum(best // 64) AS BIGINT) AS error FROM a2 GROUP BY vec_id, label),
  book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM coded, book"""
