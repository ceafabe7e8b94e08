"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers

from lectern.llm import (byte_bpe, importance, kneser_ney, line_chunks, packing, prefix_join, pstable, revisits, secrets, strata,
                         templates, turns, url_rules)
from lectern.llm.common import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return add


@query("op1_secret_scan")
def op1(spark, sf_dir):
    return secrets.secret_report(table(spark, sf_dir, "documents"))


@query("op2_byte_bpe")
def op2(spark, sf_dir):
    return byte_bpe.bpe_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                                public_tokenizers.PATTERN)


@query("op3_warc_revisits")
def op3(spark, sf_dir):
    return revisits.resolve(revisits.page_records(table(spark, sf_dir, "pages")))


@query("op4_importance_resampling")
def op4(spark, sf_dir):
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))[0]


OP5_SQL = r"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)\A.*?://([^/?#]*)', 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)\A.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
judged AS (
  SELECT page_id, host, path, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""


@query("op5_url_rules", OP5_SQL)
def op5(spark, sf_dir):
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), url_rules.rule_table(spark, url_rules.PAGE_RULES))


@query("op6_line_chunks")
def op6(spark, sf_dir):
    return line_chunks.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op7_benchmark_templates")
def op7(spark, sf_dir):
    return templates.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "covered", "n_words", "exact")


@query("op8_kneser_ney_toxicity")
def op8(spark, sf_dir):
    return kneser_ney.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_prefix_join")
def op9(spark, sf_dir):
    return prefix_join.jaccard_components(table(spark, sf_dir, "documents"), width=3, percent=90)


@query("op10_multiprobe_search")
def op10(spark, sf_dir):
    return pstable.nearest(table(spark, sf_dir, "embeddings"))


@query("op11_turn_alignment")
def op11(spark, sf_dir):
    return turns.repair_report(turns.damage(table(spark, sf_dir, "conversations")))


@query("op12_best_fit_packing")
def op12(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


OP13_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
lengths AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tfs GROUP BY doc_id),
whole AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tfs CROSS JOIN whole GROUP BY term),
strata AS (SELECT doc_id, 100 - 50 + ((50 * n * n_docs) // n_terms) AS m FROM lengths CROSS JOIN whole),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM asked JOIN tfs USING (term) JOIN weights USING (term) JOIN strata USING (doc_id) GROUP BY item_id, doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""


@query("op13_stratified_search", OP13_SQL)
def op13(spark, sf_dir):
    return strata.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
