"""Size checks: broadcast or collect a side only under a proven row bound."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.session import ensure_checkpoint_dir

# A side is broadcast only when its counted rows stay under this bound.
DEFAULT_BROADCAST_ROWS = 1_000_000
# Small driver-side tables (offsets, class parameters) must stay under this.
DEFAULT_COLLECT_ROWS = 200_000


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      known_rows: int | None = None) -> DataFrame:
    """Return ``broadcast(df)`` when it has at most ``max_rows`` rows, else ``df``.

    ``known_rows`` skips the count when the caller already knows the bound
    (e.g. a fixed class dictionary).
    """
    n = known_rows if known_rows is not None else df.count()
    return F.broadcast(df) if n <= max_rows else df


def collect_bounded(df: DataFrame, max_rows: int = DEFAULT_COLLECT_ROWS):
    """Rows of ``df`` when it has at most ``max_rows`` rows, else None.

    One job: reads at most ``max_rows + 1`` rows.
    """
    rows = df.limit(max_rows + 1).collect()
    return rows if len(rows) <= max_rows else None


def local_or_broadcast(df: DataFrame, max_rows: int = DEFAULT_COLLECT_ROWS) -> DataFrame:
    """A small computed table as a broadcast local relation (no second job
    when it is joined), or the distributed frame when it is too large."""
    rows = collect_bounded(df, max_rows)
    if rows is None:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def stable_table(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet under the session's shared
    checkpoint folder and read it back. A lost executor then re-reads the
    files instead of recomputing (possibly differently) from the source."""
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def drop_folder(spark, path: str) -> None:
    """Delete a written intermediate table after its last reader."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def default_partitions(df: DataFrame) -> int:
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(n, 1)
