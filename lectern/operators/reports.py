"""Queries over a prediction table (date-partitioned scoring output)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.hashing import seeded_order_key
from lectern.labels import SEED

ROUND = 6


def performance_trend(df: DataFrame, date_col: str = "prediction_date") -> DataFrame:
    return df.groupBy(date_col).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(F.col("correct").cast("double")), ROUND).alias("accuracy"),
        F.round(F.avg("confidence"), ROUND).alias("avg_confidence"))


def summary_stats(df: DataFrame, date_col: str = "prediction_date") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg(F.col("correct").cast("double")), ROUND).alias("accuracy"),
        F.round(F.avg("confidence"), ROUND).alias("avg_confidence"),
        F.min(date_col).alias("first_date"), F.max(date_col).alias("latest_date"))


def recent_predictions(df: DataFrame, days: int, date_col: str = "prediction_date") -> DataFrame:
    """Rows within ``days`` of the latest date (scalar subquery, one plan)."""
    latest = df.agg(F.max(date_col)).scalar()
    return df.where(F.col(date_col) >= F.date_sub(latest, days))


def eval_sample(df: DataFrame, n: int, seed: int = SEED, key_col: str = "doc_id") -> DataFrame:
    """Reproducible random n rows (top-n of a seeded hash)."""
    return df.orderBy(seeded_order_key(seed, key_col), F.col(key_col)).limit(n)
