"""Writers: staging tables, Snappy Parquet, split artefacts, appends, date partitions.

All paths are expected on shared storage (the session's checkpoint folder
or a table location); nothing is staged on a machine-local folder.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lectern.functions.timefmt import utc_stamp_now


def stage_overwrite(df: DataFrame, path: str) -> DataFrame:
    """Write (truncating first) and return the staged table read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def sink_parquet_snappy(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def sink_csv(df: DataFrame, path: str) -> str:
    """Header row, no index column."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def versioned_path(base: str, now: dt.datetime | None = None) -> str:
    """One run directory ``base/YYYY-MM-DDTHH-MM-SS`` (UTC), chosen once."""
    return os.path.join(base, utc_stamp_now(now))


def sink_splits(df: DataFrame, base: str, now: dt.datetime | None = None) -> dict[str, str]:
    """All splits in one pass under one run directory, partitioned by split."""
    run_dir = versioned_path(base, now)
    df.write.mode("overwrite").option("compression", "snappy").partitionBy("split").parquet(run_dir)
    return {s: os.path.join(run_dir, f"split={s}") for s in ("train", "val", "test")} | {"run_dir": run_dir}


def sink_predictions(df: DataFrame, base: str, now: dt.datetime | None = None) -> str:
    path = os.path.join(versioned_path(base, now), "predictions.parquet")
    df.write.mode("overwrite").parquet(path)
    return path


def _conform(df: DataFrame, schema: StructType) -> DataFrame:
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"rows lack columns {missing}")
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def write_counted(out: DataFrame, write) -> int:
    """Run ``write(observed_frame)`` and return the rows it wrote.

    The count is an observed metric of the write job itself, so the input
    (often a whole scoring plan) is computed once, not once for a count and
    again for the write.
    """
    obs = Observation("rows_written")
    write(out.observe(obs, F.count(F.lit(1)).alias("n")))
    return int(obs.get["n"])


def sink_append(df: DataFrame, path: str, schema: StructType) -> int:
    """Create if absent, append rows in the fixed schema, return the row count.

    A row that cannot be cast to the schema fails the write (ANSI casts).
    """
    out = _conform(df, schema)
    return write_counted(out, lambda o: o.write.mode("append").parquet(path))


def sink_date_partitioned(df: DataFrame, path: str, schema: StructType,
                          partition_cols: Sequence[str] = ("prediction_date",)) -> int:
    """Write partitioned by date; a rerun replaces only the partitions it
    writes (dynamic overwrite), so the same date and day never duplicate."""
    out = _conform(df, schema)
    return write_counted(out, lambda o: o.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                          .partitionBy(*partition_cols).parquet(path))


def guard_empty(df: DataFrame, fail: bool) -> bool:
    """True when rows exist. Empty: raise (sample job) or return False (daily job)."""
    has_rows = not df.isEmpty()
    if not has_rows and fail:
        raise ValueError("no rows fetched")
    return has_rows


def scan_predictions(spark: SparkSession, path: str, prefix: str = "prob_") -> tuple[DataFrame, list[str]]:
    """Read a predictions file; class names are the sorted ``prob_*`` columns."""
    df = spark.read.parquet(path)
    classes = sorted(c[len(prefix):] for c in df.columns if c.startswith(prefix))
    return df, classes
