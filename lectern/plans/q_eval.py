"""Evaluation on the logits / predictions views."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions.scores import encode_label
from lectern.labels import LABEL2ID, TOPIC_CLASSES
from lectern.operators import evaluate as ev
from lectern.operators.quantiles import box_stats
from lectern.plans.q_profile import BOX_SQL
from lectern.plans.registry import register
from lectern.plans.views import LOGITS, PREDICTIONS, TOPIC_NAME, with_
from lectern.sources.adapters import logits, predictions, scored_logits


def scored(spark, sf):
    return scored_logits(logits(spark, sf))


def preds_ids(spark, sf):
    """Prediction table with class names turned back into ids."""
    p = predictions(spark, sf)
    return p.select("*", encode_label("true_label", LABEL2ID).alias("y"),
                    encode_label("predicted_label", LABEL2ID).alias("pred"))


CM_SQL = with_(LOGITS) + """,
grid AS (SELECT a.range AS y, b.range AS pred FROM range(5) a, range(5) b),
counts AS (SELECT y, pred, count(*) AS n FROM scored2 GROUP BY y, pred),
cm AS (SELECT """ + TOPIC_NAME.format(x="g.y") + """ AS true_label, """ + TOPIC_NAME.format(x="g.pred") + """ AS predicted_label,
              CAST(coalesce(n, 0) AS BIGINT) AS n, g.y AS y, g.pred AS pred
       FROM grid g LEFT JOIN counts c ON g.y = c.y AND g.pred = c.pred)
"""

REPORT_SQL = CM_SQL + """,
per_true AS (SELECT y, sum(n) AS support, sum(n) FILTER (WHERE y = pred) AS tp FROM cm GROUP BY y),
per_pred AS (SELECT pred AS y, sum(n) AS predicted FROM cm GROUP BY pred),
pr AS (SELECT t.y, support, tp, predicted,
              CASE WHEN predicted = 0 THEN 0.0 ELSE tp / predicted END AS precision,
              CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall
       FROM per_true t JOIN per_pred p ON t.y = p.y),
report AS (SELECT """ + TOPIC_NAME.format(x="y") + """ AS label, round(precision, 6) AS precision, round(recall, 6) AS recall,
              round(CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END, 6) AS f1_score,
              CAST(support AS BIGINT) AS support FROM pr),
averages AS (
  SELECT 'macro avg' AS label, round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall,
         round(avg(f1_score), 6) AS f1_score, CAST(sum(support) AS BIGINT) AS support FROM report
  UNION ALL
  SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
         round(sum(f1_score * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM report
  UNION ALL
  SELECT 'accuracy', NULL, NULL, round(sum(recall * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM report)
"""


@register("correct_flag", with_(LOGITS) + "SELECT doc_id, y = pred AS correct FROM scored2")
def q_correct_flag(spark, sf):
    return scored(spark, sf).select("doc_id", (F.col("y") == F.col("pred")).alias("correct"))


@register("accuracy", with_(PREDICTIONS) + """
SELECT count(*) AS total, count(*) FILTER (WHERE correct) AS n_correct, count(*) FILTER (WHERE NOT correct) AS n_errors,
       round(avg(CAST(correct AS DOUBLE)), 6) AS accuracy FROM predictions""")
def q_accuracy(spark, sf):
    return ev.accuracy(predictions(spark, sf))


@register("confusion_counts", CM_SQL + "SELECT true_label, predicted_label, n, y, pred FROM cm")
def q_confusion_counts(spark, sf):
    return ev.confusion_counts(scored(spark, sf), TOPIC_CLASSES)


@register("confusion_normalised", CM_SQL + """
SELECT true_label, predicted_label,
       round(CASE WHEN sum(n) OVER (PARTITION BY y) = 0 THEN 0.0 ELSE n / sum(n) OVER (PARTITION BY y) END, 6) AS share
FROM cm""")
def q_confusion_normalised(spark, sf):
    return ev.confusion_normalised(scored(spark, sf), TOPIC_CLASSES)


@register("classification_report", REPORT_SQL + "SELECT * FROM report")
def q_classification_report(spark, sf):
    return ev.classification_report(scored(spark, sf), TOPIC_CLASSES)


@register("report_averages", REPORT_SQL + "SELECT * FROM averages")
def q_report_averages(spark, sf):
    return ev.report_averages(ev.classification_report(scored(spark, sf), TOPIC_CLASSES))


@register("report_long", REPORT_SQL + """,
allr AS (SELECT * FROM report UNION ALL SELECT * FROM averages)
SELECT label, metric, value FROM (
  SELECT label, 'precision' AS metric, precision AS value FROM allr UNION ALL
  SELECT label, 'recall', recall FROM allr UNION ALL
  SELECT label, 'f1_score', f1_score FROM allr UNION ALL
  SELECT label, 'support', CAST(support AS DOUBLE) FROM allr) WHERE value IS NOT NULL""")
def q_report_long(spark, sf):
    per = ev.classification_report(scored(spark, sf), TOPIC_CLASSES)
    return ev.report_long(per.unionByName(ev.report_averages(per)))


@register("mean_probs_by_class", with_(LOGITS) + "SELECT " + TOPIC_NAME.format(x="y") + " AS true_label, " + ", ".join(
    f"round(avg(probs[{i + 1}]), 6) AS prob_{c}" for i, c in enumerate(TOPIC_CLASSES)) + " FROM scored2 GROUP BY y")
def q_mean_probs_by_class(spark, sf):
    return ev.mean_probs_by_class(scored(spark, sf), TOPIC_CLASSES)


@register("confidence_histogram", with_(PREDICTIONS) + """,
st AS (SELECT min(confidence) AS mn, max(confidence) AS mx, avg(confidence) AS mean FROM predictions),
st2 AS (SELECT CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo, CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi, mean FROM st),
b AS (SELECT CAST(least(floor((confidence - lo) / ((hi - lo) / 20)), 19) AS BIGINT) AS bin, count(*) AS n
      FROM predictions, st2 GROUP BY 1)
SELECT r.range AS bin, round(lo + r.range * ((hi - lo) / 20), 6) AS bin_low,
       round(lo + (r.range + 1) * ((hi - lo) / 20), 6) AS bin_high,
       CAST(coalesce(n, 0) AS BIGINT) AS n, round(mean, 6) AS mean
FROM range(20) r CROSS JOIN st2 LEFT JOIN b ON b.bin = r.range""")
def q_confidence_histogram(spark, sf):
    return ev.histogram(predictions(spark, sf), "confidence", 20)


@register("confidence_box", with_(PREDICTIONS) + "," + BOX_SQL.format(g="true_label", v="confidence", t="predictions"))
def q_confidence_box(spark, sf):
    return box_stats(predictions(spark, sf), ["true_label"], "confidence")


LOSS_SQL = with_(LOGITS) + """,
rows AS (SELECT doc_id, -ln(probs[y + 1]) AS loss, CAST(y = pred AS BIGINT) AS ok,
                (row_number() OVER (ORDER BY doc_id) - 1) // 32 AS batch FROM scored2),
pb AS (SELECT batch, avg(loss) AS bl, sum(loss) AS s, count(*) AS n, sum(ok) AS ok FROM rows GROUP BY batch)
"""


@register("log_loss_batched", LOSS_SQL + """
SELECT round(avg(bl), 6) AS loss_batched, round(sum(s) / sum(n), 6) AS loss_rows,
       count(*) AS n_batches, CAST(sum(n) AS BIGINT) AS n_rows FROM pb""")
def q_log_loss_batched(spark, sf):
    return ev.log_loss_batched(scored(spark, sf), 32)


@register("evaluate_model", LOSS_SQL + """
SELECT round(avg(bl), 6) AS loss, round(sum(ok) / sum(n), 6) AS accuracy, CAST(sum(n) AS BIGINT) AS n_rows FROM pb""")
def q_evaluate_model(spark, sf):
    return ev.evaluate_model(scored(spark, sf), 32)


PCM_SQL = with_(PREDICTIONS) + """,
per_true AS (SELECT true_label AS label, count(*) AS support, count(*) FILTER (WHERE correct) AS tp
             FROM predictions GROUP BY 1),
per_pred AS (SELECT predicted_label AS label, count(*) AS predicted FROM predictions GROUP BY 1),
names AS (SELECT unnest(['business','entertainment','politics','sport','tech']) AS label),
pr AS (SELECT n.label, coalesce(support, 0) AS support, coalesce(tp, 0) AS tp, coalesce(predicted, 0) AS predicted,
              CASE WHEN coalesce(predicted, 0) = 0 THEN NULL ELSE coalesce(tp, 0) / predicted END AS precision,
              CASE WHEN coalesce(support, 0) = 0 THEN NULL ELSE coalesce(tp, 0) / support END AS recall
       FROM names n LEFT JOIN per_true t ON n.label = t.label LEFT JOIN per_pred p ON n.label = p.label)
"""


@register("per_class_metrics", PCM_SQL + """
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(CASE WHEN precision + recall = 0 THEN NULL ELSE 2 * precision * recall / (precision + recall) END, 6) AS f1_score,
       CAST(support AS BIGINT) AS support FROM pr""")
def q_per_class_metrics(spark, sf):
    return ev.classification_report(preds_ids(spark, sf), TOPIC_CLASSES, null_safe=True)


TREND_SQL = with_(PREDICTIONS) + """
SELECT prediction_date, count(*) AS n, round(avg(CAST(correct AS DOUBLE)), 6) AS accuracy,
       round(avg(confidence), 6) AS avg_confidence FROM predictions GROUP BY prediction_date"""


@register("performance_trend", TREND_SQL)
def q_performance_trend(spark, sf):
    from lectern.operators.reports import performance_trend
    return performance_trend(predictions(spark, sf))


@register("stream_performance_trend", TREND_SQL)
def q_stream_performance_trend(spark, sf):
    """The trend from a stream: a first run of every day with turned marks, its rerun, then a first run's file that comes late."""
    from lectern.plans.q_io import scratch
    from lectern.streaming.trend import current_trend, stream_run_sums

    p = predictions(spark, sf).select("doc_id", "prediction_date", F.dayofmonth("prediction_date").alias("day_partition"),
                                      "correct", "confidence")
    src, sums, mark = (scratch(spark, f"trend-{d}") for d in ("src", "sums", "mark"))
    turned = p.withColumn("correct", ~F.col("correct"))
    for rows, hour in ((turned, 6), (p, 9), (turned, 6)):
        run = rows.withColumn("run_timestamp", F.make_timestamp(F.lit(2024), F.lit(1), F.lit(8), F.lit(hour), F.lit(0), F.lit(0)))
        run.write.mode("append").parquet(src)
        stream_run_sums(spark, src, run.schema, sums, mark)
    return current_trend(spark.read.parquet(sums))


@register("summary_stats", with_(PREDICTIONS) + """
SELECT count(*) AS n, round(avg(CAST(correct AS DOUBLE)), 6) AS accuracy, round(avg(confidence), 6) AS avg_confidence,
       min(prediction_date) AS first_date, max(prediction_date) AS latest_date FROM predictions""")
def q_summary_stats(spark, sf):
    from lectern.operators.reports import summary_stats
    return summary_stats(predictions(spark, sf))


@register("recent_predictions", with_(PREDICTIONS) + """
SELECT doc_id, prediction_date, predicted_label, confidence FROM predictions
WHERE prediction_date >= (SELECT max(prediction_date) FROM predictions) - INTERVAL 7 DAY""")
def q_recent_predictions(spark, sf):
    from lectern.operators.reports import recent_predictions
    return recent_predictions(predictions(spark, sf), 7).select(
        "doc_id", "prediction_date", "predicted_label", "confidence")
