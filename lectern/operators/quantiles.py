"""Exact quantiles and box-plot numbers without collecting, sorting or ranking a group.

``percentile`` keeps every distinct value of a group in one aggregation buffer, however large the group. Here values are
first counted per (group, value), combined map-side and written once; the order statistics that a quantile needs come from
that table by rounds of narrowing (``selection.select_values``), whiskers and outliers by one more aggregate over it.
Interpolation is linear between closest ranks (the usual type-7 definition, as in numpy and DuckDB ``quantile_cont``).
Null and NaN values are left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators.selection import select_values
from lectern.operators.sizing import stable_table


def _qname(p: float) -> str:
    return "q" + f"{p:g}".replace(".", "_").replace("0_", "")


def _value_counts(df: DataFrame, group_cols: Sequence[str], value_col: str) -> DataFrame:
    """(group, _v, _n) written once."""
    v = F.col(value_col).cast("double")
    vals = df.select(*group_cols, v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    # -0.0 and 0.0 are one value
    return stable_table(vals.groupBy(*group_cols, (F.col("_v") + 0.0).alias("_v")).agg(F.count(F.lit(1)).alias("_n")), "value-counts")


def _rank_positions(n: Column, p: float) -> tuple[Column, Column, Column]:
    pos = F.lit(float(p)) * (n - 1)
    return (F.floor(pos).cast("bigint") + 1, F.ceil(pos).cast("bigint") + 1, pos - F.floor(pos))


def _quantiles(counts: DataFrame, group_cols: Sequence[str], probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    sizes = stable_table(counts.groupBy(*group_cols).agg(F.sum("_n").alias("_tot")), "group-sizes")
    ranks = [r for p in probs for r in _rank_positions(F.col("_tot"), p)[:2]]
    wanted = sizes.select(*group_cols, F.explode(F.array_distinct(F.array(*ranks))).alias("_rank"))
    found = select_values(counts, group_cols, wanted)
    at = found.groupBy(*group_cols).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at"))  # 2 ranks a quantile
    both = _join_groups(sizes, at.select(*[F.col(c).alias(f"_g_{c}") for c in group_cols], "_at"), group_cols)
    outs = []
    for p, name in zip(probs, names):
        lo, hi, frac = _rank_positions(F.col("_tot"), p)
        low, high = F.try_element_at("_at", lo), F.try_element_at("_at", hi)
        outs.append(F.when(low == high, low).otherwise(low + frac * (high - low)).alias(name))
    return both.select(*group_cols, *outs)


def exact_quantiles(df: DataFrame, group_cols: Sequence[str], value_col: str,
                    probs: Sequence[float], names: Sequence[str] | None = None) -> DataFrame:
    names = list(names) if names else [_qname(p) for p in probs]
    if not group_cols:  # one group of all rows
        return exact_quantiles(df.withColumn("_all", F.lit(0)), ["_all"], value_col, probs, names).drop("_all")
    return _quantiles(_value_counts(df, group_cols, value_col), group_cols, probs, names)


def _join_groups(left: DataFrame, right: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    cond = None
    for c in group_cols:
        e = left[c].eqNullSafe(right[f"_g_{c}"])
        cond = e if cond is None else cond & e
    return left.join(right, cond, "inner")


def box_stats(df: DataFrame, group_cols: Sequence[str], value_col: str, digits: int = 6) -> DataFrame:
    """Quartiles, whiskers at the furthest points within 1.5 IQR, outlier count."""
    if not group_cols:
        return box_stats(df.withColumn("_all", F.lit(0)), ["_all"], value_col, digits).drop("_all")
    probs, names = [0.25, 0.5, 0.75], ["q1", "median", "q3"]
    counts = _value_counts(df, group_cols, value_col)
    q = stable_table(_quantiles(counts, group_cols, probs, names).withColumn("iqr", F.col("q3") - F.col("q1")), "quartiles")
    qb = q.select(*[F.col(c).alias(f"_g_{c}") for c in group_cols],
                  (F.col("q1") - 1.5 * F.col("iqr")).alias("_lof"), (F.col("q3") + 1.5 * F.col("iqr")).alias("_hif"))
    # whiskers and outliers read the distinct-value counts, never the raw rows again
    j = _join_groups(counts, qb, group_cols)
    x, n = F.col("_v"), F.col("_n")
    w = j.groupBy(*[counts[c].alias(f"_g_{c}") for c in group_cols]).agg(
        F.min(F.when(x >= F.col("_lof"), x)).alias("whisker_low"),
        F.max(F.when(x <= F.col("_hif"), x)).alias("whisker_high"),
        F.coalesce(F.sum(F.when((x < F.col("_lof")) | (x > F.col("_hif")), n)), F.lit(0)).alias("n_outliers"),
        F.sum(n).alias("n"),
    )
    out = _join_groups(q, w, group_cols)
    return out.select(*group_cols, *[F.round(F.col(c), digits).alias(c) for c in
                                     ["q1", "median", "q3", "iqr", "whisker_low", "whisker_high"]],
                      F.col("n_outliers").cast("bigint").alias("n_outliers"), F.col("n").cast("bigint").alias("n"))
