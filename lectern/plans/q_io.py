"""Sinks, JSON requests, jobs and the streaming append."""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from lectern import schemas
from lectern.labels import LANG2ID, LANG_CLASSES
from lectern.operators import filters, naive_bayes, sampling
from lectern.operators.splits import filter_split
from lectern.plans import jobs
from lectern.plans.q_history import CONFIG_VALUES, ES_SQL
from lectern.plans.q_model import NB_SQL, nb_model, nb_sql, split_docs
from lectern.plans.registry import register
from lectern.plans.views import DOCS, PREDICTIONS, RANKED, with_
from lectern.session import ensure_checkpoint_dir
from lectern.sources import requests, sinks
from lectern.sources.adapters import predictions, request_batches
from lectern.sources.articles import docs_articles
from lectern.sources.published import Published
from lectern.sources.tables import read_table, scan_csv
from lectern.streaming.request_stream import stream_requests
from lectern.streaming.score_append import stream_score_append

RUN_TS = dt.datetime(2024, 1, 8, 6, 30, 0, tzinfo=dt.timezone.utc)

SAMPLE_TEST = """test AS (SELECT doc_id, title, body, category, body AS text FROM docs_articles
    WHERE body IS NOT NULL AND title IS NOT NULL
    ORDER BY md5('42' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 100)"""
SAMPLE_ROWS = """SELECT t.doc_id, t.title, t.body, t.category, p2.cls AS predicted_label
FROM test t JOIN p2 ON p2.doc_id = t.doc_id AND p2.r = 1"""
DAY_NUMBERED = """numbered AS (
    SELECT doc_id, title, body, category,
           CAST(row_number() OVER (ORDER BY title, doc_id) % 30 AS BIGINT) AS day_num
    FROM docs_articles WHERE body IS NOT NULL AND title IS NOT NULL)"""


def scratch(spark, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex}")


PRED_COLS = ["doc_id", "prediction_date", "true_label", "predicted_label", "confidence", "score_business",
             "score_entertainment", "score_politics", "score_sport", "score_tech", "correct"]
PRED_SCHEMA = ("doc_id bigint, prediction_date date, true_label string, predicted_label string, confidence double, "
               "score_business double, score_entertainment double, score_politics double, score_sport double, "
               "score_tech double, correct boolean")


@register("sink_csv", with_(PREDICTIONS) + "SELECT * FROM predictions")
def q_sink_csv(spark, sf):
    path = sinks.sink_csv(predictions(spark, sf), scratch(spark, "csv"))
    return scan_csv(spark, path, PRED_SCHEMA)


@register("scan_csv", with_(PREDICTIONS) + """
SELECT true_label, count(*) AS n, round(avg(confidence), 6) AS avg_confidence FROM predictions GROUP BY true_label""")
def q_scan_csv(spark, sf):
    path = sinks.sink_csv(predictions(spark, sf), scratch(spark, "csv"))
    return scan_csv(spark, path, PRED_SCHEMA).groupBy("true_label").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("confidence"), 6).alias("avg_confidence"))


@register("stage_overwrite", with_(DOCS) + "SELECT doc_id, title, category FROM docs_articles WHERE category = 'en'")
def q_stage_overwrite(spark, sf):
    """Stage twice at one path: the second write truncates the first."""
    path = scratch(spark, "stage")
    d = docs_articles(spark, sf).select("doc_id", "title", "category")
    sinks.stage_overwrite(d, path)
    return sinks.stage_overwrite(d.where(F.col("category") == "en"), path)


@register("sink_parquet_snappy", with_(DOCS) + "SELECT doc_id, title, body, category FROM docs_articles")
def q_sink_parquet_snappy(spark, sf):
    path = sinks.sink_parquet_snappy(docs_articles(spark, sf), scratch(spark, "snappy"))
    return spark.read.parquet(path)


@register("sink_splits", with_(RANKED) + """
SELECT split, category, count(*) AS n FROM splitted GROUP BY split, category""")
def q_sink_splits(spark, sf):
    paths = sinks.sink_splits(split_docs(spark, sf), scratch(spark, "splits"), RUN_TS)
    return spark.read.parquet(paths["run_dir"]).groupBy("split", "category").agg(F.count(F.lit(1)).alias("n"))


@register("versioned_path")
def q_versioned_path(spark, sf):
    """Every split file sits under the same run stamp."""
    paths = sinks.sink_splits(split_docs(spark, sf), scratch(spark, "splits"))
    df = spark.read.parquet(paths["run_dir"]).select("split", F.input_file_name().alias("file"))
    stamp = F.regexp_extract("file", r"/(\d{4}-\d{2}-\d{2}T\d{2}-\d{2}-\d{2})/", 1)
    return df.groupBy("split", stamp.alias("run_stamp")).agg(F.count(F.lit(1)).alias("n"))


@register("sink_predictions", with_(PREDICTIONS) + "SELECT * FROM predictions")
def q_sink_predictions(spark, sf):
    path = sinks.sink_predictions(predictions(spark, sf), scratch(spark, "preds"), RUN_TS)
    return spark.read.parquet(path)


@register("scan_predictions", with_(PREDICTIONS) + """
SELECT doc_id,
       CAST(list_position(['business','entertainment','politics','sport','tech'], predicted_label) - 1 AS BIGINT) AS pred_id,
       CAST(list_position(['business','entertainment','politics','sport','tech'], true_label) - 1 AS BIGINT) AS true_id
FROM predictions""")
def q_scan_predictions(spark, sf):
    p = predictions(spark, sf)
    wide = p.select("doc_id", "true_label", "predicted_label",
                    *[F.col(c).alias("prob_" + c[len("score_"):]) for c in p.columns if c.startswith("score_")])
    path = sinks.sink_predictions(wide, scratch(spark, "preds"), RUN_TS)
    df, classes = sinks.scan_predictions(spark, path)
    names = F.array(*[F.lit(c) for c in classes])
    return df.select("doc_id", (F.array_position(names, F.col("predicted_label")) - 1).cast("bigint").alias("pred_id"),
                     (F.array_position(names, F.col("true_label")) - 1).cast("bigint").alias("true_id"))


@register("sink_append", nb_sql(SAMPLE_TEST) + SAMPLE_ROWS + " UNION ALL " + SAMPLE_ROWS)
def q_sink_append(spark, sf):
    """Append the scored 100-row sample twice: the table holds both appends."""
    path = scratch(spark, "append")
    model = nb_model(spark, sf)
    d = docs_articles(spark, sf)
    jobs.job_sample_inference(spark, d, model, path)
    jobs.job_sample_inference(spark, d, model, path)
    return spark.read.parquet(path)


@register("sink_date_partitioned", with_(PREDICTIONS) + "SELECT * FROM predictions")
def q_sink_date_partitioned(spark, sf):
    """Written twice with dynamic partition overwrite: no duplicate rows."""
    path = scratch(spark, "dated")
    schema = schemas.StructType.fromDDL(PRED_SCHEMA) if hasattr(schemas.StructType, "fromDDL") else None
    p = predictions(spark, sf)
    schema = p.schema
    sinks.sink_date_partitioned(p, path, schema)
    sinks.sink_date_partitioned(p, path, schema)
    return spark.read.parquet(path).select(*PRED_COLS)


@register("request_json", """
SELECT conv_id, CAST(turn // 256 AS BIGINT) AS chunk,
       CAST(row_number() OVER (PARTITION BY conv_id, turn // 256 ORDER BY turn) - 1 AS BIGINT) AS pos, text
FROM conversations""")
def q_request_json(spark, sf):
    rows, _ = requests.request_json(request_batches(spark, sf))
    return rows


@register("response_json")
def q_response_json(spark, sf):
    rows, rejected = requests.request_json(request_batches(spark, sf))
    model = nb_model(spark, sf)
    scored = naive_bayes.score_nb(model, rows, key_col=["conv_id", "chunk", "pos"])
    return requests.response_json(scored, model.class_names)


RESPONSE_TEST = """reqs AS (SELECT conv_id, CAST(turn // 256 AS BIGINT) AS chunk, text,
                 CAST(row_number() OVER (PARTITION BY conv_id, turn // 256 ORDER BY turn) - 1 AS BIGINT) AS pos FROM conversations),
test AS (SELECT conv_id || '/' || chunk || '/' || pos AS doc_id, 'en' AS category, * FROM reqs)"""


RESPONSE_SQL = nb_sql(RESPONSE_TEST) + """
SELECT t.conv_id, t.chunk, t.pos, any_value(cls) FILTER (WHERE r = 1) AS label,
       round(any_value(prob) FILTER (WHERE r = 1), 4) AS confidence,
       round(any_value(prob) FILTER (WHERE cls = 'de'), 4) AS score_de,
       round(any_value(prob) FILTER (WHERE cls = 'en'), 4) AS score_en,
       round(any_value(prob) FILTER (WHERE cls = 'es'), 4) AS score_es,
       round(any_value(prob) FILTER (WHERE cls = 'fr'), 4) AS score_fr
FROM test t JOIN p2 ON p2.doc_id = t.doc_id GROUP BY t.conv_id, t.chunk, t.pos"""


@register("response_rows", RESPONSE_SQL)
def q_response_rows(spark, sf):
    """The JSON responses read back, one row per instance."""
    return requests.response_rows(q_response_json(spark, sf), LANG_CLASSES)


@register("request_rejects", """
SELECT conv_id, chunk, 'instances list is empty' AS reason
FROM (SELECT conv_id, CAST(turn // 256 AS BIGINT) AS chunk, role FROM conversations)
GROUP BY conv_id, chunk HAVING count(*) FILTER (WHERE role = 'system') = 0
UNION ALL SELECT conv_id, CAST(-1 - turn AS BIGINT), 'malformed request' FROM conversations""")
def q_request_rejects(spark, sf):
    """Rejected requests come back with their reason: chunks asked for their system turns only, and bare texts."""
    turns = read_table(spark, sf, "conversations", ["conv_id", "turn", "role", "text"])
    text = F.when(F.col("role") == "system", F.struct("text"))
    asked = turns.groupBy("conv_id", F.floor(F.col("turn") / 256).cast("bigint").alias("chunk")).agg(
        F.to_json(F.struct(F.collect_list(text).alias("instances"))).alias("request"))
    bare = turns.select("conv_id", (F.lit(-1) - F.col("turn")).cast("bigint").alias("chunk"), F.col("text").alias("request"))
    return requests.request_json(asked.unionByName(bare))[1]


@register("guard_empty", with_(DOCS) + "," + DAY_NUMBERED + " SELECT doc_id, title FROM numbered WHERE day_num = 7")
def q_guard_empty(spark, sf):
    """Daily slice guard: a non-empty slice passes through, an empty one would return 0 rows written."""
    from lectern.operators.splits import filter_day

    d = filter_day(docs_articles(spark, sf), 7).select("doc_id", "title")
    sinks.guard_empty(d, fail=True)
    return d


@register("with_run_columns", with_(DOCS) + """
SELECT doc_id, TIMESTAMP '2024-01-08 06:30:00' AS prediction_timestamp, DATE '2024-01-08' AS prediction_date,
       CAST(7 AS BIGINT) AS day_partition FROM docs_articles""")
def q_with_run_columns(spark, sf):
    d = docs_articles(spark, sf).select("doc_id")
    out = filters.with_run_columns(d, RUN_TS.replace(tzinfo=None), RUN_TS.date(), 7)
    return out.withColumn("prediction_timestamp", F.col("prediction_timestamp").cast("timestamp_ntz"))


DAILY_SQL = nb_sql("""numbered AS (
    SELECT doc_id, title, body, category,
           CAST(row_number() OVER (ORDER BY title, doc_id) % 30 AS BIGINT) AS day_num
    FROM docs_articles WHERE body IS NOT NULL AND title IS NOT NULL),
test AS (SELECT doc_id, title, body, category, body AS text FROM numbered WHERE day_num = 7)""") + """
SELECT DATE '2024-01-08' AS prediction_date, TIMESTAMP '2024-01-08 06:30:00' AS run_timestamp, t.doc_id, t.title, t.body,
       t.category AS true_label, any_value(cls) FILTER (WHERE r = 1) AS predicted_label,
       round(any_value(prob) FILTER (WHERE r = 1), 6) AS confidence,
       round(any_value(prob) FILTER (WHERE cls = 'de'), 6) AS score_de,
       round(any_value(prob) FILTER (WHERE cls = 'en'), 6) AS score_en,
       round(any_value(prob) FILTER (WHERE cls = 'es'), 6) AS score_es,
       round(any_value(prob) FILTER (WHERE cls = 'fr'), 6) AS score_fr,
       CAST(7 AS BIGINT) AS day_partition
FROM test t JOIN p2 ON p2.doc_id = t.doc_id GROUP BY t.doc_id, t.title, t.body, t.category"""


@register("daily_predictions", DAILY_SQL)
def q_daily_predictions(spark, sf):
    out = jobs.daily_frame(docs_articles(spark, sf), nb_model(spark, sf), 7, RUN_TS)
    rounded = [F.round(c, 6).alias(c) for c in out.columns if c.startswith("score_") or c == "confidence"]
    keep = [c for c in out.columns if not (c.startswith("score_") or c == "confidence")]
    return out.select(*keep, *rounded).withColumn("run_timestamp", F.col("run_timestamp").cast("timestamp_ntz"))


@register("job_daily_inference", nb_sql(DAY_NUMBERED + """,
test AS (SELECT doc_id, title, body, category, body AS text, day_num FROM numbered WHERE day_num IN (7, 8))""") + """
SELECT t.doc_id, t.day_num AS day_partition, p2.cls AS predicted_label, round(p2.prob, 6) AS confidence
FROM test t JOIN p2 ON p2.doc_id = t.doc_id AND p2.r = 1""")
def q_job_daily_inference(spark, sf):
    """Run day 7 twice for the same date (rerun-safe) and day 8 once; read the table."""
    path = scratch(spark, "daily")
    model = nb_model(spark, sf)
    d = docs_articles(spark, sf)
    jobs.job_daily_inference(spark, d, model, path, day=7, now=RUN_TS)
    jobs.job_daily_inference(spark, d, model, path, day=7, now=RUN_TS)
    jobs.job_daily_inference(spark, d, model, path, day=8, now=RUN_TS)
    return spark.read.parquet(path).select("doc_id", F.col("day_partition").cast("bigint").alias("day_partition"),
                                           "predicted_label", F.round("confidence", 6).alias("confidence"))


@register("job_daily_published", nb_sql(DAY_NUMBERED + """,
test AS (SELECT doc_id, title, body, category, body AS text, day_num FROM numbered WHERE day_num IN (7, 9))""") + """
SELECT t.doc_id, t.day_num AS day_partition, p2.cls AS predicted_label, round(p2.prob, 6) AS confidence
FROM test t JOIN p2 ON p2.doc_id = t.doc_id AND p2.r = 1""")
def q_job_daily_published(spark, sf):
    """Days 7 (twice), 8 and 9 published, then day 8 again from a source without rows, which takes it away; read back."""
    base = scratch(spark, "published")
    model = nb_model(spark, sf)
    d = docs_articles(spark, sf)
    for day in (7, 7, 8, 9):
        jobs.job_daily_published(spark, d, model, base, day=day, now=RUN_TS)
    jobs.job_daily_published(spark, d.where("title IS NULL"), model, base, day=8, now=RUN_TS)
    table = Published(spark, base, schemas.daily_prediction(model.class_names))
    table.collect()
    return table.read().select("doc_id", "day_partition", "predicted_label", F.round("confidence", 6).alias("confidence"))


@register("job_sample_inference", nb_sql(SAMPLE_TEST) + """
SELECT t.doc_id, t.title, t.body, t.category, p2.cls AS predicted_label, CAST(100 AS BIGINT) AS rows_written
FROM test t JOIN p2 ON p2.doc_id = t.doc_id AND p2.r = 1""")
def q_job_sample_inference(spark, sf):
    path = scratch(spark, "sample")
    n = jobs.job_sample_inference(spark, docs_articles(spark, sf), nb_model(spark, sf), path)
    return spark.read.parquet(path).withColumn("rows_written", F.lit(n).cast("bigint"))


@register("job_train")
def q_job_train(spark, sf):
    out = jobs.job_train(spark, docs_articles(spark, sf), LANG2ID, scratch(spark, "train"), now=RUN_TS)
    return out["report"]


REPORT_SQL = NB_SQL + """,
""" + ES_SQL.removeprefix("WITH ").replace("ranked", "by_value") + f""",
cfg(position, parameter, param, dflt) AS (VALUES {CONFIG_VALUES}),
pr AS (SELECT doc_id, true_label, cls AS pred FROM p2 WHERE r = 1),
cl(c) AS (VALUES ('de'), ('en'), ('es'), ('fr')),
cm AS (SELECT a.c AS t, b.c AS q, count(pr.doc_id) AS n FROM cl a CROSS JOIN cl b
       LEFT JOIN pr ON pr.true_label = a.c AND pr.pred = b.c GROUP BY 1, 2),
tot AS (SELECT c, (SELECT sum(n) FROM cm WHERE t = c) AS support, (SELECT sum(n) FROM cm WHERE q = c) AS predicted,
               (SELECT sum(n) FROM cm WHERE t = c AND q = c) AS tp FROM cl),
pr2 AS (SELECT c, support, CASE WHEN predicted = 0 THEN 0 ELSE tp / predicted END AS prec,
               CASE WHEN support = 0 THEN 0 ELSE tp / support END AS rec FROM tot),
per AS (SELECT c AS label, round(prec, 6) AS prec, round(rec, 6) AS rec,
               round(CASE WHEN prec + rec = 0 THEN 0 ELSE 2 * prec * rec / (prec + rec) END, 6) AS f1, support FROM pr2),
av AS (SELECT 'macro avg' AS label, avg(prec) AS prec, avg(rec) AS rec, avg(f1) AS f1, sum(support) AS support FROM per
       UNION ALL SELECT 'weighted avg', sum(prec * support) / sum(support), sum(rec * support) / sum(support),
                        sum(f1 * support) / sum(support), sum(support) FROM per
       UNION ALL SELECT 'accuracy', NULL, NULL, sum(rec * support) / sum(support), sum(support) FROM per),
figures AS (
  SELECT 'training_curves' AS "table", run || '/' || step AS key, key AS figure, value FROM metric_history
  UNION ALL SELECT 'confusion', t || '/' || q, 'n', n FROM cm
  UNION ALL SELECT 'confusion_normalised', t || '/' || q, 'share',
                   round(CASE WHEN sum(n) OVER (PARTITION BY t) = 0 THEN 0 ELSE n / sum(n) OVER (PARTITION BY t) END, 6) FROM cm
  UNION ALL SELECT 'per_class', label, unnest(['precision', 'recall', 'f1_score', 'support']), unnest([prec, rec, f1, support::DOUBLE]) FROM per
  UNION ALL SELECT 'averages', label, unnest(['precision', 'recall', 'f1_score', 'support']),
                   unnest([round(prec, 6), round(rec, 6), round(f1, 6), support::DOUBLE]) FROM av
  UNION ALL SELECT 'early_stop', run, unnest(['stop_step', 'n_steps', 'best_step', 'best_value']),
                   unnest([stop_step::DOUBLE, n_steps::DOUBLE, best_step::DOUBLE, best_value]) FROM es
  UNION ALL SELECT 'summary', '', unnest(['total', 'n_correct', 'n_errors', 'accuracy']),
                   unnest([count(*)::DOUBLE, count(*) FILTER (WHERE true_label = pred)::DOUBLE, count(*) FILTER (WHERE true_label <> pred)::DOUBLE,
                           round(avg(CASE WHEN true_label = pred THEN 1.0 ELSE 0.0 END), 6)]) FROM pr)
SELECT "table", key, figure, CAST(value AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text FROM figures WHERE value IS NOT NULL
UNION ALL SELECT 'config', r.run, c.parameter, NULL, CASE WHEN c.param = 'epochs' THEN r.last ELSE c.dflt END
FROM (SELECT run, CAST(max(step) AS VARCHAR) AS last FROM metric_history GROUP BY run) r CROSS JOIN cfg c"""


@register("job_report", REPORT_SQL)
def q_job_report(spark, sf):
    """All eight report tables over the NB test predictions and the events-derived history, as one long table."""
    from lectern.sources.adapters import metric_history

    s = split_docs(spark, sf)
    m = nb_model(spark, sf, s)
    scored = naive_bayes.score_nb(m, filter_split(s, "test"), keep=["category"])
    preds = jobs.predictions_frame(scored, LANG_CLASSES, True)
    return jobs.report_rows(jobs.job_report(preds, metric_history(spark, sf), LANG_CLASSES))


@register("stream_score_append", nb_sql("""test AS (SELECT doc_id, title, body, category, body AS text
    FROM docs_articles WHERE body IS NOT NULL)""") + """
SELECT t.doc_id, t.title, t.category, p2.cls AS predicted_label, round(p2.prob, 6) AS confidence
FROM test t JOIN p2 ON p2.doc_id = t.doc_id AND p2.r = 1""")
def q_stream_score_append(spark, sf):
    """New article files arrive in a folder; the stream scores and appends each once."""
    src = scratch(spark, "stream-src")
    d = docs_articles(spark, sf).where("body IS NOT NULL")
    d.repartition(4, "doc_id").write.parquet(src)
    sink = scratch(spark, "stream-sink")
    ck = scratch(spark, "stream-ck")
    stream_score_append(spark, src, d.schema, nb_model(spark, sf), sink, ck)
    # a second run finds no new files and writes nothing
    stream_score_append(spark, src, d.schema, nb_model(spark, sf), sink, ck)
    return spark.read.parquet(sink).select("doc_id", "title", "category", "predicted_label", "confidence")


@register("stream_requests", RESPONSE_SQL)
def q_stream_requests(spark, sf):
    """All requests arrive as lines of files; the stream answers each once, whatever runs follow."""
    src, out, mark = (scratch(spark, f"requests-{d}") for d in ("src", "out", "mark"))
    lines = request_batches(spark, sf).select(F.concat(
        F.lit('{"conv_id":'), "conv_id", F.lit(',"chunk":'), "chunk", F.lit(","), F.expr("substring(request, 2)")).alias("value"))
    lines.write.text(src)
    model = nb_model(spark, sf)
    for _ in range(2):  # the second run finds no new files
        stream_requests(spark, src, model, out, scratch(spark, "requests-rejects"), mark)
    return requests.response_rows(spark.read.parquet(out), LANG_CLASSES)
