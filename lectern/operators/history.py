"""Run-history analysis over a long metric table (run, step, key, value).

Per-run windows only see one run's steps (epochs), a small bounded set;
everything across runs is a plain keyed aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.sources.sinks import write_counted
from lectern.labels import REPORT_CONFIG_ROWS

HISTORY_KEYS = ["train_loss", "train_acc", "val_loss", "val_acc"]


def metrics_read(history: DataFrame) -> DataFrame:
    """Per (run, key): steps, last value (by step) and the ordered history."""
    pairs = F.sort_array(F.collect_list(F.struct("step", "value")))
    text = F.array_join(F.transform(pairs, lambda s: F.concat(
        s["step"].cast("string"), F.lit(":"), s["value"].cast("decimal(18,6)").cast("string"))), ",")
    return history.groupBy("run", "key").agg(
        F.count(F.lit(1)).alias("n_steps"),
        F.max_by("value", "step").alias("last_value"),
        text.alias("history"))


def early_stop(history: DataFrame, patience: int = 3, metric: str = "val_acc") -> DataFrame:
    """Replay early stopping: best starts at 0.0, a strict gain resets the
    counter, the run stops at the first step whose counter reaches patience.

    Returns (run, stop_step, n_steps, best_step, best_value); best_step is
    NULL when no step ever beat 0.0.
    """
    h = history.where(F.col("key") == metric).select("run", "step", "value")
    w = Window.partitionBy("run").orderBy("step")
    prev_best = F.greatest(F.lit(0.0), F.coalesce(
        F.max("value").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    h = h.withColumn("_pos", F.row_number().over(w)).withColumn("_imp", F.col("value") > prev_best)
    h = h.withColumn("_last", F.max(F.when(F.col("_imp"), F.col("_pos")).otherwise(0))
                     .over(w.rowsBetween(Window.unboundedPreceding, 0)))
    h = h.withColumn("_no_improve", F.col("_pos") - F.col("_last"))
    stops = h.groupBy("run").agg(
        F.min(F.when(F.col("_no_improve") >= patience, F.col("_pos"))).alias("_stop_pos"),
        F.max("_pos").alias("_n"))
    stops = stops.withColumn("_stop_pos", F.coalesce("_stop_pos", "_n"))
    j = h.join(stops, "run").where(F.col("_pos") <= F.col("_stop_pos"))
    best = F.min_by(F.struct(F.col("step"), F.col("value")), F.struct(-F.col("value"), F.col("step")))
    out = j.groupBy("run").agg(
        F.max(F.when(F.col("_pos") == F.col("_stop_pos"), F.col("step"))).alias("stop_step"),
        F.first("_n").cast("bigint").alias("n_steps"),
        F.max(F.when(F.col("_imp"), F.col("value"))).alias("_bv"),
        best.alias("_b"))
    has_best = F.col("_bv").isNotNull()
    return out.select("run", F.col("stop_step").cast("bigint").alias("stop_step"), "n_steps",
                      F.when(has_best, F.col("_b.step")).cast("bigint").alias("best_step"),
                      F.when(has_best, F.col("_b.value")).alias("best_value"))


def best_epoch(history: DataFrame, patience: int = 3, metric: str = "val_acc") -> DataFrame:
    return early_stop(history, patience, metric).select("run", "best_step", "best_value")


def training_curves(history: DataFrame, keys: Sequence[str] = HISTORY_KEYS) -> DataFrame:
    """The four series per (run, step) side by side (plot-ready)."""
    return history.groupBy("run", "step").pivot("key", list(keys)).agg(F.first("value"))


def require_history(history: DataFrame) -> DataFrame:
    if history.isEmpty():
        raise ValueError("metric history is empty")
    return history


def run_params(history: DataFrame) -> DataFrame:
    """Parameters a run's history reveals: the number of epochs logged."""
    return history.groupBy("run").agg(F.max("step").cast("string").alias("epochs")) \
        .select("run", F.lit("epochs").alias("param"), F.col("epochs").alias("value"))


def report_config_rows(runs: DataFrame, params: DataFrame) -> DataFrame:
    """Nine (parameter, value) rows per run: run parameter, else config default."""
    rows = F.array(*[F.struct(F.lit(i + 1).cast("bigint").alias("position"), F.lit(name).alias("parameter"),
                              F.lit(key).alias("param"), F.lit(default).alias("default"))
                     for i, (name, key, default) in enumerate(REPORT_CONFIG_ROWS)])
    grid = runs.select("run").distinct().select("run", F.inline(rows))
    j = grid.join(params, ["run", "param"], "left")
    return j.select("run", "position", "parameter", F.coalesce("value", "default").alias("value"))


def metrics_append(history: DataFrame, path: str) -> int:
    """Append per-epoch rows to the long metric table; returns rows written."""
    return write_counted(history.select("run", "step", "key", "value"), lambda o: o.write.mode("append").parquet(path))
