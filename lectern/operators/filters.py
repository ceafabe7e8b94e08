"""Projection and filter operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def project_rename(df: DataFrame, text_col: str = "body", label_col: str = "category",
                   title_col: str = "title", key_col: str = "doc_id") -> DataFrame:
    """``label_col AS category, text_col AS text``."""
    return df.select(F.col(key_col).alias("doc_id"), F.col(title_col).alias("title"),
                     F.col(label_col).alias("category"), F.col(text_col).alias("text"))


def filter_not_null(df: DataFrame, cols: Sequence[str] = ("text", "label", "title")) -> DataFrame:
    """Training rows: all listed columns non-NULL."""
    return df.dropna(how="any", subset=list(cols))


def filter_scorable(df: DataFrame, body_col: str = "body", title_col: str = "title") -> DataFrame:
    """Inference rows: body and title non-NULL; category may be NULL."""
    return df.where(F.col(body_col).isNotNull() & F.col(title_col).isNotNull())


def filter_correct(df: DataFrame, flag: str = "correct") -> DataFrame:
    return df.where(F.col(flag))


def filter_errors(df: DataFrame, flag: str = "correct") -> DataFrame:
    return df.where(~F.col(flag))


def correct_flag(true_col: str, pred_col: str):
    return (F.col(true_col) == F.col(pred_col)).alias("correct")


def append_prediction(df: DataFrame, predicted) -> DataFrame:
    """All input columns plus ``predicted_label``."""
    return df.withColumn("predicted_label", predicted)


def optional_labels(df: DataFrame, label_col: str = "label") -> bool:
    """True when the frame carries labels (then true_label/correct are emitted)."""
    return label_col in df.columns


def with_run_columns(df: DataFrame, run_ts, run_date, day_bucket: int) -> DataFrame:
    """Constant run columns fixed once on the driver."""
    return df.select("*",
                     F.lit(run_ts).cast("timestamp").alias("prediction_timestamp"),
                     F.lit(run_date).cast("date").alias("prediction_date"),
                     F.lit(day_bucket).cast("bigint").alias("day_partition"))
