"""Profiling and data-quality queries."""

from __future__ import annotations

from lectern.functions.text import word_count
from lectern.operators import profile
from lectern.operators.quantiles import box_stats
from lectern.plans.registry import register
from lectern.plans.views import DOCS, with_
from lectern.sources.articles import docs_articles


@register("class_distribution", with_(DOCS) + """
SELECT category, count(*) AS n FROM docs_articles GROUP BY category""")
def q_class_distribution(spark, sf):
    return profile.class_distribution(docs_articles(spark, sf))


@register("text_length_profile", with_(DOCS) + """
SELECT category, round(avg(length(body)), 6) AS avg_chars, CAST(max(length(body)) AS BIGINT) AS max_chars,
       CAST(min(length(body)) AS BIGINT) AS min_chars, round(avg(len(string_split(body, ' '))), 6) AS avg_words
FROM docs_articles GROUP BY category""")
def q_text_length_profile(spark, sf):
    return profile.text_length_profile(docs_articles(spark, sf))


@register("word_count_rows", with_(DOCS) + """
SELECT doc_id, category, CAST(len(string_split(body, ' ')) AS BIGINT) AS word_count FROM docs_articles""")
def q_word_count_rows(spark, sf):
    return profile.word_count_rows(docs_articles(spark, sf))


BOX_SQL = """
q AS (SELECT {g}, quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.5) AS median,
             quantile_cont({v}, 0.75) AS q3 FROM {t} GROUP BY {g}),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lof, q3 + 1.5 * (q3 - q1) AS hif FROM q)
SELECT x.{g}, round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3,
       round(any_value(iqr), 6) AS iqr,
       round(min({v}) FILTER (WHERE {v} >= lof), 6) AS whisker_low,
       round(max({v}) FILTER (WHERE {v} <= hif), 6) AS whisker_high,
       count(*) FILTER (WHERE {v} < lof OR {v} > hif) AS n_outliers,
       count({v}) AS n
FROM {t} x JOIN f ON x.{g} IS NOT DISTINCT FROM f.{g} GROUP BY x.{g}"""


@register("word_count_box", with_(DOCS) + """,
wc AS (SELECT category, CAST(len(string_split(body, ' ')) AS DOUBLE) AS word_count FROM docs_articles),
""" + BOX_SQL.format(g="category", v="word_count", t="wc"))
def q_word_count_box(spark, sf):
    d = docs_articles(spark, sf).select("category", word_count("body").alias("word_count"))
    return box_stats(d, ["category"], "word_count")


@register("quality_counts", with_(DOCS) + """
SELECT count(*) FILTER (WHERE body IS NULL) AS null_body, count(*) FILTER (WHERE title IS NULL) AS null_title,
       count(*) FILTER (WHERE category IS NULL) AS null_category,
       count(*) FILTER (WHERE length(body) < 100) AS short_body, count(*) AS total_rows
FROM docs_articles""")
def q_quality_counts(spark, sf):
    return profile.quality_counts(docs_articles(spark, sf))


@register("distinct_categories", with_(DOCS) + "SELECT DISTINCT category FROM docs_articles")
def q_distinct_categories(spark, sf):
    return profile.distinct_categories(docs_articles(spark, sf))
