"""Error analysis, joins and prediction-table samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions.scores import decode_label, true_confidence
from lectern.functions.text import preview
from lectern.labels import LANG2ID, TOPIC_CLASSES
from lectern.operators import filters, joins
from lectern.operators.reports import eval_sample
from lectern.plans.registry import register
from lectern.plans.views import DOCS, LANG_CASE, LOGITS, PAGES, PREDICTIONS, TOPIC_NAME, with_
from lectern.sources.adapters import logits, predictions, scored_logits
from lectern.sources.articles import docs_articles, pages_articles


@register("filter_correct", with_(PREDICTIONS) + """
SELECT doc_id, true_label, predicted_label FROM predictions WHERE correct""")
def q_filter_correct(spark, sf):
    return filters.filter_correct(predictions(spark, sf)).select("doc_id", "true_label", "predicted_label")


@register("filter_errors", with_(PREDICTIONS) + """
SELECT doc_id, true_label, predicted_label FROM predictions WHERE NOT correct""")
def q_filter_errors(spark, sf):
    return filters.filter_errors(predictions(spark, sf)).select("doc_id", "true_label", "predicted_label")


@register("error_listing", with_(DOCS, LOGITS.replace("logits AS (", "logits AS (", 1)) + """
SELECT s.doc_id, """ + TOPIC_NAME.format(x="y") + """ AS true_label, """ + TOPIC_NAME.format(x="pred") + """ AS predicted_label,
       round(confidence, 6) AS confidence, round(probs[y + 1], 6) AS true_confidence, left(d.body, 200) AS preview
FROM scored2 s JOIN docs_articles d ON s.doc_id = d.doc_id WHERE y <> pred""")
def q_error_listing(spark, sf):
    s = scored_logits(logits(spark, sf))
    errs = filters.filter_errors(s.withColumn("correct", F.col("y") == F.col("pred")))
    errs = errs.select("doc_id", decode_label("y", TOPIC_CLASSES).alias("true_label"),
                       decode_label("pred", TOPIC_CLASSES).alias("predicted_label"),
                       F.round("confidence", 6).alias("confidence"),
                       F.round(true_confidence("probs", "y"), 6).alias("true_confidence"))
    docs = docs_articles(spark, sf).select("doc_id", preview("body", 200).alias("preview"))
    return joins.join_predictions(errs, docs)


@register("least_confident_k", with_(PREDICTIONS) + """
SELECT doc_id, true_label, predicted_label, confidence FROM predictions ORDER BY confidence, doc_id LIMIT 5""")
def q_least_confident_k(spark, sf):
    p = predictions(spark, sf).select("doc_id", "true_label", "predicted_label", "confidence")
    return p.orderBy("confidence", "doc_id").limit(5)


@register("join_predictions", with_(DOCS, PREDICTIONS) + """
SELECT d.doc_id, d.title, d.category, p.predicted_label, p.confidence, p.correct
FROM docs_articles d JOIN predictions p ON d.doc_id = p.doc_id""")
def q_join_predictions(spark, sf):
    d = docs_articles(spark, sf).select("doc_id", "title", "category")
    p = predictions(spark, sf).select("doc_id", "predicted_label", "confidence", "correct")
    return joins.join_predictions(d, p)


@register("join_label_dict", with_(PAGES) + f"""
SELECT doc_id, category, CAST({LANG_CASE} AS BIGINT) AS label FROM pages_articles""")
def q_join_label_dict(spark, sf):
    p = pages_articles(spark, sf).select("doc_id", "category")
    return joins.join_label_dict(p, LANG2ID)


@register("llm_eval_sample", with_(DOCS, PREDICTIONS) + """
SELECT p.doc_id, d.body, p.true_label, p.predicted_label, p.confidence
FROM predictions p JOIN docs_articles d ON d.doc_id = p.doc_id
ORDER BY md5('42' || CAST(p.doc_id AS VARCHAR)), p.doc_id LIMIT 20""")
def q_eval_sample(spark, sf):
    p = predictions(spark, sf).select("doc_id", "true_label", "predicted_label", "confidence")
    d = docs_articles(spark, sf).select("doc_id", "body")
    return eval_sample(joins.join_predictions(p, d), 20)


@register("append_prediction", with_(DOCS) + """
SELECT doc_id, title, category, CASE WHEN length(body) > 1000 THEN 'long' ELSE 'short' END AS predicted_label
FROM docs_articles WHERE body IS NOT NULL AND title IS NOT NULL""")
def q_append_prediction(spark, sf):
    """All input columns plus ``predicted_label`` (here a length rule as the model)."""
    d = filters.filter_scorable(docs_articles(spark, sf)).select("doc_id", "title", "body", "category")
    out = filters.append_prediction(d, F.when(F.length("body") > 1000, "long").otherwise("short"))
    return out.drop("body")
