"""End-to-end jobs composed from the operators.

Each job is one Spark application: steps hand DataFrames to each other and
write their artefacts at versioned paths on shared storage so a restarted
job can resume from the last written step.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern import schemas
from lectern.functions.text import clean_text, clean_title, text_with_title
from lectern.functions.timefmt import day_bucket_of, validate_day
from lectern.labels import DAY_BUCKETS, SAMPLE_INFERENCE_ROWS, TEST_PCT, VAL_PCT
from lectern.operators import evaluate as ev
from lectern.operators import epoch_trainer, filters, history, naive_bayes, sampling, splits
from lectern.operators.sizing import stable_table
from lectern.sources import sinks
from lectern.sources.articles import scan_articles
from lectern.sources.published import Published


def clean_and_split(raw: DataFrame, test_pct: int = TEST_PCT, val_pct: int = VAL_PCT,
                    normalize: bool = True) -> DataFrame:
    """Rank on the raw title, then clean title and text (the reference's order)."""
    s = splits.stratified_split(raw, test_pct, val_pct)
    return s.select("doc_id", clean_title("title", normalize).alias("title"), "category", "label",
                    clean_text("text", normalize).alias("text"), "split")


def predictions_frame(scored: DataFrame, classes: Sequence[str], has_labels: bool) -> DataFrame:
    cols = ["doc_id", F.col("predicted_label").alias("predicted"), "confidence"]
    if has_labels:
        cols += [F.col("category").alias("true_label"), (F.col("category") == F.col("predicted_label")).alias("correct")]
    cols += [F.col("probs")[i].alias(f"prob_{c}") for i, c in enumerate(classes)]
    return scored.select(*cols)


def class_ids(scored: DataFrame, classes: Sequence[str]) -> DataFrame:
    """(doc_id, y, pred, z, probs) of scored rows with a true ``category``."""
    names = F.array(*[F.lit(c) for c in classes])
    return scored.select("doc_id", (F.array_position(names, F.col("category")) - 1).cast("bigint").alias("y"), "pred", "z", "probs")


def job_train(spark: SparkSession, source: DataFrame, mapping: Mapping[str, int], out_base: str,
              test_pct: int = TEST_PCT, val_pct: int = VAL_PCT, now: dt.datetime | None = None,
              normalize: bool = True, trainer: str = "nb", config: epoch_trainer.TrainConfig | None = None,
              sample_size: int | None = None, use_title: bool = False) -> dict:
    """extract -> clean + split -> train -> predict test -> evaluate.

    ``trainer``: "nb" counts the train split once; "epochs" trains over epochs, chooses the epoch on the validation split and
    logs train and validation figures of each. ``sample_size``: about so many rows of the source, the same on every run.
    ``use_title``: the classifier reads title and text. The test figures by class are logged as metrics of the run.
    """
    if trainer not in ("nb", "epochs"):
        raise ValueError(f"unknown trainer {trainer}")
    classes = [c for c, _ in sorted(mapping.items(), key=lambda kv: kv[1])]
    raw = scan_articles(source, mapping).where(F.col("label").isNotNull())
    if sample_size is not None:
        raw = sampling.sample_hash_row(raw, sample_size, source.count())
    raw_path = sinks.sink_parquet_snappy(raw, os.path.join(sinks.versioned_path(os.path.join(out_base, "raw"), now),
                                                           "raw.parquet"))
    raw = spark.read.parquet(raw_path)
    split_paths = sinks.sink_splits(clean_and_split(raw, test_pct, val_pct, normalize),
                                    os.path.join(out_base, "processed"), now)
    staged = spark.read.parquet(split_paths["run_dir"])
    if use_title:
        staged = staged.withColumn("text", text_with_title("title", "text"))
    run = os.path.basename(split_paths["run_dir"])
    model_path, history_path = os.path.join(out_base, "model", run), os.path.join(out_base, "history")
    train, val, test = (splits.filter_split(staged, s) for s in ("train", "val", "test"))
    if trainer == "nb":
        naive_bayes.train_nb(train, classes).save(model_path)
        model = naive_bayes.NaiveBayesModel.load(spark, model_path)
        scored = naive_bayes.score_nb(model, test, keep=["category"])
    else:
        model, epochs = epoch_trainer.train_epochs(train, val, classes, os.path.join(out_base, "run", run),
                                                   config or epoch_trainer.TrainConfig())
        history.metrics_append(epochs.withColumn("run", F.lit(run)), history_path)
        model.save(spark, model_path)
        model = epoch_trainer.EpochModel.load(spark, model_path)
        scored = epoch_trainer.score_epochs(model, test, keep=["category"])
    scored = stable_table(scored, "test-scores")  # predictions, report and losses all read these rows
    pred_path = sinks.sink_predictions(predictions_frame(scored, classes, True),
                                       os.path.join(out_base, "predictions"), now)
    ids = class_ids(scored, classes)
    report = stable_table(ev.full_report(ids, classes), "report")
    metrics = ev.report_long(report).select(F.lit(run).alias("run"), F.lit(0).cast("bigint").alias("step"),
                                            F.concat(F.lit("test_"), "label", F.lit("_"), "metric").alias("key"), "value")
    history.metrics_append(metrics, history_path)
    return {"raw": raw_path, "splits": split_paths, "model": model_path, "predictions": pred_path, "run": run,
            "history": history_path, "report": report, "evaluation": ev.evaluate_model(ids), "classes": classes}


def job_sample_inference(spark: SparkSession, source: DataFrame, model: naive_bayes.NaiveBayesModel,
                         table_path: str, n: int = SAMPLE_INFERENCE_ROWS, seed: int = 42) -> int:
    """Random n scorable rows -> score the raw body -> append; returns the row count."""
    # the fetch step's output is written once (at most n rows), so the guard
    # and the scoring read it instead of re-running the top-n over the source
    rows = stable_table(sampling.random_sample_n(filters.filter_scorable(source), n, seed), "sample-fetch")
    sinks.guard_empty(rows, fail=True)
    scored = naive_bayes.score_nb(model, rows, text_col="body", keep=["title", "body", "category"])
    return sinks.sink_append(scored, table_path, schemas.SAMPLE_PREDICTION)


def daily_frame(source: DataFrame, model: naive_bayes.NaiveBayesModel, day: int,
                run_ts: dt.datetime, buckets: int = DAY_BUCKETS, rows: DataFrame | None = None) -> DataFrame:
    """The day's slice (or ``rows``, if it is at hand) scored, in the daily table's columns."""
    validate_day(day, buckets)
    rows = splits.filter_day(source, day, buckets) if rows is None else rows
    scored = naive_bayes.score_nb(model, rows, text_col="body", keep=["title", "body", "category"])
    cols = [F.lit(run_ts.date()).alias("prediction_date"),
            F.lit(run_ts.replace(tzinfo=None)).cast("timestamp").alias("run_timestamp"),
            "doc_id", "title", "body", F.col("category").alias("true_label"), "predicted_label", "confidence"]
    cols += [F.col("probs")[i].alias(f"score_{c}") for i, c in enumerate(model.class_names)]
    cols += [F.lit(day).cast("bigint").alias("day_partition")]
    return scored.select(*cols)


def job_daily_inference(spark: SparkSession, source: DataFrame, model: naive_bayes.NaiveBayesModel,
                        table_path: str, day: int | None = None, now: dt.datetime | None = None) -> int:
    """Today's 1/30 slice -> score -> date-partitioned write; rerun-safe."""
    now = now or dt.datetime.now(dt.timezone.utc)
    day = day_bucket_of(now.day) if day is None else day
    rows = stable_table(splits.filter_day(source, day), "day-slice")
    if not sinks.guard_empty(rows, fail=False):
        return 0
    out = daily_frame(source, model, day, now, rows=rows)
    return sinks.sink_date_partitioned(out, table_path, schemas.daily_prediction(model.class_names),
                                       ("prediction_date", "day_partition"))


def job_daily_published(spark: SparkSession, source: DataFrame, model: naive_bayes.NaiveBayesModel, base: str,
                        day: int | None = None, now: dt.datetime | None = None) -> int:
    """The daily job with its rows published by a manifest: a killed run is never read, a rerun replaces its day at once, and
    a rerun that finds no rows takes the old ones away. Returns the rows published."""
    now = now or dt.datetime.now(dt.timezone.utc)
    day = day_bucket_of(now.day) if day is None else day
    rows = stable_table(splits.filter_day(source, day), "day-slice")
    table = Published(spark, base, schemas.daily_prediction(model.class_names))
    return table.publish(daily_frame(source, model, day, now, rows=rows), f"{now.date()}/{day}")


def job_report(predictions: DataFrame, metric_history: DataFrame, classes: Sequence[str],
               patience: int = 3) -> dict[str, DataFrame]:
    """All report tables: curves, confusion, per-class, averages, run parameters, summary.

    Predictions and history are written once; every table reads those.
    """
    metric_history = history.require_history(stable_table(metric_history, "report-history"))
    names = F.array(*[F.lit(c) for c in classes])
    ids = stable_table(predictions.select(
        "doc_id", (F.array_position(names, F.col("true_label")) - 1).cast("bigint").alias("y"),
        (F.array_position(names, F.col("predicted")) - 1).cast("bigint").alias("pred")), "report-predictions")
    per_class = ev.classification_report(ids, classes)
    return {
        "training_curves": history.training_curves(metric_history),
        "confusion": ev.confusion_counts(ids, classes),
        "confusion_normalised": ev.confusion_normalised(ids, classes),
        "per_class": per_class,
        "averages": ev.report_averages(per_class),
        "config": history.report_config_rows(metric_history, history.run_params(metric_history)),
        "early_stop": history.early_stop(metric_history, patience),
        "summary": ev.accuracy(ids.withColumn("correct", F.col("y").eqNullSafe(F.col("pred")))),
    }


# Of each report table: the columns that name a figure, and those that hold figures.
REPORT_COLUMNS = {
    "training_curves": (["run", "step"], history.HISTORY_KEYS),
    "confusion": (["true_label", "predicted_label"], ["n"]),
    "confusion_normalised": (["true_label", "predicted_label"], ["share"]),
    "per_class": (["label"], ["precision", "recall", "f1_score", "support"]),
    "averages": (["label"], ["precision", "recall", "f1_score", "support"]),
    "early_stop": (["run"], ["stop_step", "n_steps", "best_step", "best_value"]),
    "summary": ([], ["total", "n_correct", "n_errors", "accuracy"]),
}


def report_rows(bundle: Mapping[str, DataFrame]) -> DataFrame:
    """The whole bundle as one table: (table, key, figure, value, text); figures in ``value``, run parameters in ``text``."""
    parts = [bundle["config"].select(F.lit("config").alias("table"), F.col("run").alias("key"), F.col("parameter").alias("figure"),
                                     F.lit(None).cast("double").alias("value"), F.col("value").alias("text"))]
    for name, (keys, figures) in REPORT_COLUMNS.items():
        key = F.concat_ws("/", *[F.col(k).cast("string") for k in keys]) if keys else F.lit("")
        wide = bundle[name].select(key.alias("key"), *[F.col(f).cast("double").alias(f) for f in figures])
        long = wide.unpivot(["key"], figures, "figure", "value").where(F.col("value").isNotNull())
        parts.append(long.select(F.lit(name).alias("table"), "key", "figure", "value", F.lit(None).cast("string").alias("text")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
