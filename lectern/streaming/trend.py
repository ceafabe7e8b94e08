"""The daily performance figures kept up to date by a stream over arriving prediction files.

A micro-batch adds its sums per (date, slot, run): a handful of rows, combined map-side, whatever the number of predictions.
They are written to a folder of the query id and batch number with overwrite, so a replayed batch replaces its own sums.
Reading takes, per date and slot, the sums of the latest run only: a rerun of a day replaces the day's figures, a file that
arrives late adds to its run's, and files of an earlier run that arrive after a later one change nothing. Nothing is dropped for
lateness, so the table always equals the batch figures over all rows of the latest runs.

Defined cases: rows without a date, or without a run time, form a group of their own (a NULL run is the earliest); a NULL in
``correct`` or ``confidence`` counts as a row but not in its average; no files give no days.
"""

from __future__ import annotations

import os
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from lectern.operators.reports import ROUND

SUMS = ["n", "n_judged", "n_correct", "n_confidence", "sum_confidence"]


def run_sums(df: DataFrame, date_col: str, slot_col: str, run_col: str) -> DataFrame:
    """Additive figures per (date, slot, run)."""
    return df.groupBy(F.col(date_col).alias("prediction_date"), F.col(slot_col).alias("slot"), F.col(run_col).alias("run")).agg(
        F.count(F.lit(1)).alias("n"), F.count("correct").alias("n_judged"), F.count_if("correct").alias("n_correct"),
        F.count("confidence").alias("n_confidence"), F.sum("confidence").alias("sum_confidence"))


def stream_run_sums(spark: SparkSession, source_dir: str, schema: StructType, sums_dir: str, checkpoint_dir: str,
                    date_col: str = "prediction_date", slot_col: str = "day_partition", run_col: str = "run_timestamp",
                    max_files: int | None = None):
    """Add the files that have arrived to the sums; returns the finished query."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    started, ids = threading.Event(), []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        run_sums(batch, date_col, slot_col, run_col).coalesce(1).write.mode("overwrite").parquet(
            os.path.join(sums_dir, f"query_id={ids[0]}", f"batch_id={batch_id}"))

    # only the columns of the figures are read from the files
    columns = [date_col, slot_col, run_col, "correct", "confidence"]
    query = (reader.parquet(source_dir).select(*columns).writeStream.foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    ids.append(query.id)  # kept in the checkpoint: the same after a restart
    started.set()
    query.awaitTermination()
    return query


def current_trend(sums: DataFrame, days: int | None = None) -> DataFrame:
    """(prediction_date, n, accuracy, avg_confidence) of the latest runs; ``days`` keeps those within so many of the latest."""
    runs = sums.groupBy("prediction_date", "slot", "run").agg(*[F.sum(c).alias(c) for c in SUMS])
    newest = Window.partitionBy("prediction_date", "slot").orderBy(F.col("run").desc_nulls_last())  # one row per run
    daily = runs.withColumn("_r", F.row_number().over(newest)).where("_r = 1") \
        .groupBy("prediction_date").agg(*[F.sum(c).alias(c) for c in SUMS])
    if days is not None:
        daily = daily.where(F.col("prediction_date") >= F.date_sub(daily.agg(F.max("prediction_date")).scalar(), days))
    return daily.select("prediction_date", "n",
                        F.round(F.try_divide(F.col("n_correct"), F.col("n_judged")), ROUND).alias("accuracy"),
                        F.round(F.try_divide(F.col("sum_confidence"), F.col("n_confidence")), ROUND).alias("avg_confidence"))
