"""Cleaning and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions.farmhash import farm_fingerprint
from lectern.functions import hashing, scores, text, timefmt
from lectern.labels import TOPIC_CLASSES
from lectern.plans.registry import register
from lectern.plans.views import DOCS, LOGITS, PAGES, with_
from lectern.sources.adapters import logits, scored_logits
from lectern.sources.articles import docs_articles, pages_articles
from lectern.sources.tables import read_table

def collapse_sql(x: str) -> str:
    inner = r"regexp_replace(" + x + r", '\s+', ' ', 'g')"
    return r"regexp_replace(" + inner + r", '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')"


def tags_sql(x: str) -> str:
    return r"regexp_replace(" + x + r", '<[^>]+>', ' ', 'g')"


def ents_sql(x: str) -> str:
    return r"regexp_replace(" + x + r", '&(?:amp|lt|gt|quot|apos|nbsp);|&#\d+;', ' ', 'g')"


@register("strip_tags", with_(PAGES) + f"SELECT doc_id, {tags_sql('body')} AS text FROM pages_articles")
def q_strip_tags(spark, sf):
    return pages_articles(spark, sf).select("doc_id", text.strip_tags("body").alias("text"))


@register("strip_entities", with_(PAGES) + f"SELECT doc_id, {ents_sql('body')} AS text FROM pages_articles")
def q_strip_entities(spark, sf):
    return pages_articles(spark, sf).select("doc_id", text.strip_entities("body").alias("text"))


@register("collapse_ws", with_(DOCS) + f"SELECT doc_id, {collapse_sql('body')} AS text FROM docs_articles")
def q_collapse_ws(spark, sf):
    return docs_articles(spark, sf).select("doc_id", text.collapse_ws("body").alias("text"))


@register("nfkc", with_(PAGES) + "SELECT doc_id, nfc_normalize(body) AS text FROM pages_articles")
def q_nfkc(spark, sf):
    """DuckDB has only NFC: the ligature U+FB01 is put in for "fi" here, which NFC would leave and NFKC takes apart."""
    body = F.replace(F.col("body"), F.lit("fi"), F.lit("\ufb01"))
    return pages_articles(spark, sf).select("doc_id", text.nfkc(body).alias("text"))


@register("clean_article", with_(PAGES) + f"""
SELECT doc_id, nfc_normalize({collapse_sql('title')}) AS title, category,
       nfc_normalize({collapse_sql(ents_sql(tags_sql('body')))}) AS text
FROM pages_articles""")
def q_clean_article(spark, sf):
    """The oracle uses NFC (DuckDB has no NFKC); equal here as no test row holds
    compatibility characters. NFKC-only cases are covered by hand tests."""
    p = pages_articles(spark, sf)
    return p.select("doc_id", text.clean_title("title").alias("title"), "category",
                    text.clean_text("body").alias("text"))


@register("fingerprint", with_(DOCS) + """
SELECT doc_id, ('0x' || substr(md5(title), 1, 8))::BIGINT AS fp FROM docs_articles""")
def q_fingerprint(spark, sf):
    return docs_articles(spark, sf).select("doc_id", hashing.fingerprint("title").alias("fp"))


@register("farm_fingerprint")
def q_farm_fingerprint(spark, sf):
    """Signed 64-bit FarmHash fingerprint of the whole body."""
    return docs_articles(spark, sf).select("doc_id", farm_fingerprint("body").alias("fp"))


@register("abs_mod", """
SELECT doc_id, CAST(n_chars % 100 AS BIGINT) AS m100, CAST(doc_id % 30 AS BIGINT) AS m30 FROM documents""")
def q_abs_mod(spark, sf):
    d = read_table(spark, sf, "documents", ["doc_id", "n_chars"])
    return d.select("doc_id", hashing.abs_mod("n_chars", 100).cast("bigint").alias("m100"),
                    hashing.abs_mod("doc_id", 30).cast("bigint").alias("m30"))


@register("char_length", with_(DOCS) + """
SELECT doc_id, CAST(length(body) AS BIGINT) AS n_chars FROM docs_articles""")
def q_char_length(spark, sf):
    return docs_articles(spark, sf).select("doc_id", text.char_length("body").alias("n_chars"))


@register("word_count", with_(DOCS) + """
SELECT doc_id, CAST(len(string_split(body, ' ')) AS BIGINT) AS word_count FROM docs_articles""")
def q_word_count(spark, sf):
    return docs_articles(spark, sf).select("doc_id", text.word_count("body").alias("word_count"))


@register("case_when", with_(DOCS) + """
SELECT doc_id,
       CASE WHEN length(body) < 100 THEN 'short' WHEN length(body) < 1000 THEN 'medium' ELSE 'long' END AS size_class
FROM docs_articles""")
def q_case_when(spark, sf):
    n = F.length("body")
    return docs_articles(spark, sf).select(
        "doc_id", F.when(n < 100, "short").when(n < 1000, "medium").otherwise("long").alias("size_class"))


@register("sample_pct", """
SELECT CAST(least(round_even(300 / count(*) * 100, 0), 100) AS BIGINT) AS pct,
       CAST(count(*) AS BIGINT) AS total FROM documents""")
def q_sample_pct(spark, sf):
    d = read_table(spark, sf, "documents", ["doc_id"])
    n = F.count(F.lit(1))
    return d.agg(F.least(F.bround(F.lit(300) / n * 100, 0), F.lit(100)).cast("bigint").alias("pct"),
                 n.alias("total"))


@register("day_of_month_bucket", """
SELECT event_id, CAST((day(ts) - 1) % 30 AS BIGINT) AS day_bucket FROM events""")
def q_day_bucket(spark, sf):
    e = read_table(spark, sf, "events", ["event_id", "ts"])
    return e.select("event_id", timefmt.day_of_month_bucket("ts").alias("day_bucket"))


@register("utc_stamp", """
SELECT event_id, strftime(ts, '%Y-%m-%dT%H-%M-%S') AS stamp FROM events""")
def q_utc_stamp(spark, sf):
    e = read_table(spark, sf, "events", ["event_id", "ts"])
    return e.select("event_id", timefmt.utc_stamp("ts").alias("stamp"))


PROB_COLS_SQL = ", ".join(f"round(probs[{i + 1}], 6) AS prob_{c}" for i, c in enumerate(TOPIC_CLASSES))


def _probs_cols():
    return [F.round(F.col("probs")[i], 6).alias(f"prob_{c}") for i, c in enumerate(TOPIC_CLASSES)]


@register("softmax", with_(LOGITS) + f"SELECT doc_id, {PROB_COLS_SQL} FROM scored2")
def q_softmax(spark, sf):
    return scored_logits(logits(spark, sf)).select("doc_id", *_probs_cols())


@register("argmax_label", with_(LOGITS) + "SELECT doc_id, pred FROM scored2")
def q_argmax(spark, sf):
    return scored_logits(logits(spark, sf)).select("doc_id", "pred")


@register("confidence", with_(LOGITS) + """
SELECT doc_id, round(confidence, 6) AS confidence, round(probs[y + 1], 6) AS true_confidence FROM scored2""")
def q_confidence(spark, sf):
    s = scored_logits(logits(spark, sf))
    return s.select("doc_id", F.round("confidence", 6).alias("confidence"),
                    F.round(scores.true_confidence("probs", "y"), 6).alias("true_confidence"))


@register("scores_map")
def q_scores_map(spark, sf):
    s = scored_logits(logits(spark, sf))
    return s.select("doc_id", scores.scores_map("probs", TOPIC_CLASSES).alias("scores"))


@register("scores_wide", with_(LOGITS) + "SELECT doc_id, " + ", ".join(
    f"CASE WHEN probs[{i + 1}] >= 0.2 THEN round(probs[{i + 1}], 6) ELSE 0.0 END AS prob_{c}"
    for i, c in enumerate(TOPIC_CLASSES)) + " FROM scored2")
def q_scores_wide(spark, sf):
    """Map holding only classes scored >= 0.2; absent classes come out as 0.0."""
    s = scored_logits(logits(spark, sf))
    m = F.map_filter(scores.scores_map(F.transform("probs", lambda p: F.round(p, 6)), TOPIC_CLASSES),
                     lambda k, v: v >= 0.2)
    return s.select("doc_id", *scores.scores_wide(m, TOPIC_CLASSES))


@register("round4", with_(LOGITS) + "SELECT doc_id, round(confidence, 4) AS confidence4 FROM scored2")
def q_round4(spark, sf):
    s = scored_logits(logits(spark, sf))
    return s.select("doc_id", scores.round4("confidence").alias("confidence4"))


@register("safe_divide", with_(LOGITS) + """
SELECT y, round(CASE WHEN count(*) FILTER (WHERE pred = 4) = 0 THEN NULL
              ELSE count(*) FILTER (WHERE pred = y) / count(*) FILTER (WHERE pred = 4) END, 6) AS ratio
FROM scored2 GROUP BY y""")
def q_safe_divide(spark, sf):
    s = scored_logits(logits(spark, sf))
    g = s.groupBy("y").agg(F.count_if(F.col("pred") == F.col("y")).alias("a"),
                           F.count_if(F.col("pred") == 4).alias("b"))
    return g.select("y", F.round(scores.safe_divide(F.col("a").cast("double"), "b"), 6).alias("ratio"))


@register("true_confidence", with_(LOGITS) + "SELECT doc_id, round(probs[y + 1], 6) AS true_confidence FROM scored2")
def q_true_confidence(spark, sf):
    s = scored_logits(logits(spark, sf))
    return s.select("doc_id", F.round(scores.true_confidence("probs", "y"), 6).alias("true_confidence"))
