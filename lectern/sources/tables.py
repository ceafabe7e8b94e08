"""Parquet / CSV scans with explicit column lists so pruning reaches the file."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def balance(df: DataFrame, key: str) -> DataFrame:
    """Spread a scan that yields fewer partitions than the cluster has cores.

    A large input already arrives in many file splits and is returned as is
    (no shuffle); a file of one row group would otherwise put all per-row
    text work of the first stage on one core. Hash-partitioned on ``key``,
    so the placement is deterministic on a retry.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df._jdf.queryExecution().executedPlan().execute().getNumPartitions() < cores:
        return df.repartition(cores, key)
    return df


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: Sequence[str] | None = None, balance_key: str | None = None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    df = df.select(*columns) if columns else df
    return balance(df, balance_key) if balance_key else df


def scan_external(spark: SparkSession, path: str, view: str | None = None) -> DataFrame:
    """Parquet files as a table, schema taken from the files; optional temp view."""
    df = spark.read.parquet(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def scan_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header row and a fixed schema (no inference pass)."""
    return spark.read.option("header", True).schema(schema).csv(path)
