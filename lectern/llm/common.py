"""Helpers shared by the operators: table scans, written intermediate tables, null-safe text."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lectern.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage with a table that survives the loss of executors and lets several readers share one computation.
    """
    return staged_at(df, name)[0]


def staged_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``staged`` with the table's folder, for those who delete it after its last reader."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def whole_text(col: str = "text") -> Column:
    """The text itself; null counts as empty."""
    return F.coalesce(F.col(col), F.lit(""))
