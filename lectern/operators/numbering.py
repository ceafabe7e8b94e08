"""Exact row numbering that scales past one task per group.

``row_number() over (partition by g order by k)`` sends each group to one
task, so a class holding a third of the rows would be sorted by a single
core. ``exact_row_number`` replaces it at every size: rows are
range-partitioned on (group, order), sorted and numbered inside each
partition, then written once to the shared checkpoint folder (so numbers and
offsets describe the same rows even after an executor loss). The
per-(partition, group) counts give the offsets. ``hashed_rank`` is the same
for an order by a digest.

Offsets tables hold at most groups + partitions rows; they are
joined as broadcast local relations under a row bound, and as a shuffle
join beyond it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators.sizing import local_or_broadcast, stable_table


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    cond = None
    for c in keys:
        e = left[c].eqNullSafe(right[f"{prefix}{c}"])
        cond = e if cond is None else cond & e
    return cond


def hashed_rank(df: DataFrame, group_cols: Sequence[str], digest: Column, tiebreak: Sequence[Column],
                out_col: str = "rn") -> DataFrame:
    """1-based rank by (digest, tiebreak...) within each group, NULL digests first.

    ``tiebreak`` makes the order total (ascending columns), so even one digest shared by many rows is cut over tasks.
    """
    ranked = exact_row_number(df.withColumn("_dg", digest), group_cols,
                              [F.col("_dg").asc_nulls_first(), *tiebreak], out_col)
    return ranked.select(*[F.col(c) for c in df.columns], out_col)


def exact_row_number(df: DataFrame, partition_cols: Sequence[str], order_cols: Sequence[Column],
                     out_col: str = "rn", num_partitions: int | None = None) -> DataFrame:
    """Add ``out_col`` = 1-based row number of each row in its group.

    ``order_cols`` must be ascending sort expressions (``F.col(x).asc_nulls_first()``
    etc.) that make the order total (end with a unique key).
    """
    part = [F.col(c).asc_nulls_first() for c in partition_cols]
    ranged = (
        (df.repartitionByRange(num_partitions, *part, *order_cols) if num_partitions
         else df.repartitionByRange(*part, *order_cols))
        .sortWithinPartitions(*part, *order_cols)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn("_li", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("bigint"), 33))
    )
    ranged = stable_table(ranged, "numbering")
    stats = ranged.groupBy("_pid", *partition_cols).agg(
        F.min("_li").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*partition_cols).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stats.select(
        F.col("_pid").alias("_opid"), *[F.col(c).alias(f"_g_{c}") for c in partition_cols], "_first",
        F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"),
    )
    offsets = local_or_broadcast(offsets)
    cond = ranged["_pid"] == offsets["_opid"]
    if partition_cols:
        cond = cond & _null_safe_join(ranged, offsets, partition_cols, "_g_")
    out = ranged.join(offsets, cond, "inner")
    rn = (F.col("_off") + F.col("_li") - F.col("_first") + 1).cast("bigint")
    return out.select(*[ranged[c] for c in df.columns], rn.alias(out_col))


def global_row_number(df: DataFrame, order_cols: Sequence[Column], out_col: str = "rn",
                      num_partitions: int | None = None) -> DataFrame:
    """``row_number() over (order by ...)`` without a single-task window."""
    return exact_row_number(df, [], order_cols, out_col, num_partitions)
