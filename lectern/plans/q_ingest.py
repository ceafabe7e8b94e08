"""Scans, projections, filters, label encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions.scores import decode_label, encode_label
from lectern.functions.text import preview, text_with_title
from lectern.labels import LANG2ID, LANG_CLASSES
from lectern.operators import filters
from lectern.plans.registry import register
from lectern.plans.views import DOCS, LANG_CASE, PAGES, with_
from lectern.sources.articles import docs_articles, pages_articles, scan_articles, scan_projected
from lectern.sources.footers import footer_statistics, table_bytes
from lectern.sources.tables import scan_external, table_path


@register("scan_articles", with_(DOCS) + f"""
SELECT doc_id, title, category, body AS text, CAST({LANG_CASE} AS BIGINT) AS label
FROM docs_articles
WHERE body IS NOT NULL AND category IS NOT NULL AND title IS NOT NULL""")
def q_scan_articles(spark, sf):
    return scan_articles(docs_articles(spark, sf), LANG2ID)


@register("scan_external", """
SELECT lang, count(*) AS n_docs, CAST(sum(n_chars) AS BIGINT) AS total_chars
FROM documents GROUP BY lang""")
def q_scan_external(spark, sf):
    scan_external(spark, table_path(sf, "documents"), view="ext_documents")
    return spark.sql("""
        SELECT lang, count(*) AS n_docs, CAST(sum(n_chars) AS BIGINT) AS total_chars
        FROM ext_documents GROUP BY lang""")


@register("scan_projected", with_(DOCS) + f"""
SELECT doc_id, body AS text, CAST({LANG_CASE} AS BIGINT) AS label, title
FROM docs_articles
WHERE body IS NOT NULL AND category IS NOT NULL AND title IS NOT NULL""")
def q_scan_projected(spark, sf):
    return scan_projected(scan_articles(docs_articles(spark, sf), LANG2ID), use_title=True)


@register("project_rename", with_(PAGES) + """
SELECT doc_id, title, category, body AS text FROM pages_articles""")
def q_project_rename(spark, sf):
    return filters.project_rename(pages_articles(spark, sf), text_col="body", label_col="category")


@register("label_encode", with_(PAGES) + f"""
SELECT doc_id, category, CAST({LANG_CASE} AS BIGINT) AS label FROM pages_articles""")
def q_label_encode(spark, sf):
    p = pages_articles(spark, sf)
    return p.select("doc_id", "category", encode_label("category", LANG2ID).alias("label"))


@register("label_decode", with_(PAGES) + f"""
, enc AS (SELECT doc_id, CAST({LANG_CASE} AS BIGINT) AS label FROM pages_articles)
SELECT doc_id, label, list_extract(['de','en','es','fr'], label + 1) AS category FROM enc""")
def q_label_decode(spark, sf):
    p = pages_articles(spark, sf).select("doc_id", encode_label("category", LANG2ID).alias("label"))
    return p.select("doc_id", "label", decode_label("label", LANG_CLASSES).alias("category"))


@register("filter_not_null", with_(PAGES) + """
SELECT doc_id, title, category FROM pages_articles
WHERE body IS NOT NULL AND category IS NOT NULL AND title IS NOT NULL""")
def q_filter_not_null(spark, sf):
    p = pages_articles(spark, sf)
    return filters.filter_not_null(p, ["body", "category", "title"]).select("doc_id", "title", "category")


@register("filter_scorable", with_(PAGES) + """
SELECT doc_id, title, category FROM pages_articles
WHERE body IS NOT NULL AND title IS NOT NULL""")
def q_filter_scorable(spark, sf):
    return filters.filter_scorable(pages_articles(spark, sf)).select("doc_id", "title", "category")


@register("text_with_title", with_(DOCS) + """
SELECT doc_id, title || ' ' || body AS text FROM docs_articles""")
def q_text_with_title(spark, sf):
    d = docs_articles(spark, sf)
    return d.select("doc_id", text_with_title("title", "body").alias("text"))


@register("preview", with_(DOCS) + """
SELECT doc_id, category, left(body, 300) AS preview FROM docs_articles""")
def q_preview(spark, sf):
    d = docs_articles(spark, sf)
    return d.select("doc_id", "category", preview("body").alias("preview"))


@register("table_metadata", """
SELECT column_name, column_type, ordinal, n_rows FROM (
  SELECT 'doc_id' AS column_name, 'bigint' AS column_type, CAST(1 AS BIGINT) AS ordinal UNION ALL
  SELECT 'text', 'string', 2 UNION ALL SELECT 'lang', 'string', 3 UNION ALL
  SELECT 'source', 'string', 4 UNION ALL SELECT 'n_chars', 'bigint', 5) c,
  (SELECT count(*) AS n_rows FROM documents) n""")
def q_table_metadata(spark, sf):
    from lectern.operators.profile import table_metadata
    return table_metadata(spark.read.parquet(table_path(sf, "documents")))


def _footer_sql(table: str, columns: list[tuple[str, str]]) -> str:
    """One row per column; texts have no extremes in footers."""
    rows = []
    for i, (name, kind) in enumerate(columns, 1):
        lo, hi = ("NULL", "NULL") if kind == "string" else (f"min({name})", f"max({name})")
        rows.append(f"SELECT '{table}' AS table_name, '{name}' AS column_name, '{kind}' AS column_type, CAST({i} AS BIGINT) AS ordinal, "
                    f"count(*) AS n_rows, count(*) - count({name}) AS n_nulls, CAST({lo} AS DOUBLE) AS min_value, "
                    f"CAST({hi} AS DOUBLE) AS max_value FROM {table}")
    return " UNION ALL ".join(rows)


FOOTER_TABLES = {
    "documents": [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint")],
    "events": [("event_id", "bigint"), ("user_id", "bigint"), ("event_type", "string"), ("value", "double"), ("props", "string")],
}


@register("table_footer_statistics", " UNION ALL ".join(_footer_sql(t, c) for t, c in FOOTER_TABLES.items()))
def q_table_footer_statistics(spark, sf):
    """Rows, nulls and extremes of whole tables from their footers."""
    parts = [footer_statistics(spark, table_path(sf, t), [c for c, _ in columns]).select(F.lit(t).alias("table_name"), "*")
             for t, columns in FOOTER_TABLES.items()]
    return parts[0].unionByName(parts[1])


@register("table_bytes")
def q_table_bytes(spark, sf):
    """Files and bytes of ``documents``, from the listing."""
    return table_bytes(spark, table_path(sf, "documents"))
