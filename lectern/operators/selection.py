"""Order statistics of groups without sorting or numbering their rows.

Both selections narrow ranges in rounds. A round counts, per group and wanted rank, how many rows fall into each of at most
``PIECES`` pieces of the current range (a keyed aggregate, combined map-side, so a group or value with most of the rows costs
one partial row per task) and keeps the piece that holds the rank. Only those counts are ordered, never rows, and one
algorithm serves every size; no table is collected.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators.sizing import stable_table

PIECES = 1 << 16
DIGITS = 4  # hex digits a round: PIECES pieces


def _same(left: DataFrame, right: DataFrame, cols: Sequence[str], prefix: str) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & left[c].eqNullSafe(right[f"{prefix}{c}"])
    return cond


def _renamed(df: DataFrame, cols: Sequence[str], prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(f"{prefix}{c}") if c in cols else F.col(c) for c in df.columns])


def _piece(v: Column, lo: Column, hi: Column, scaled: bool) -> Column:
    """0..PIECES-1, never falling as ``v`` grows from lo to hi, which always get different pieces, so every round narrows.

    ``scaled`` measures by the logarithm, which tells values of very different size apart; halving keeps the width finite.
    """
    greatest = v == hi
    if scaled:
        v, lo, hi = (F.signum(x) * F.log1p(F.abs(x)) for x in (v, lo, hi))
    part = (v / 2 - lo / 2) / F.nullif(hi / 2 - lo / 2, F.lit(0.0)) * (PIECES - 1)
    inner = F.least(F.greatest(F.floor(F.coalesce(part, F.lit(0.0))), F.lit(0)), F.lit(PIECES - 1)).cast("int")
    infinite = (F.abs(lo) == float("inf")) | (F.abs(hi) == float("inf"))
    return F.when(greatest, PIECES - 1).when(infinite, F.when(v == lo, 0).otherwise(1)).otherwise(F.least(inner, F.lit(PIECES - 2)))


def select_values(counts: DataFrame, group_cols: Sequence[str], wanted: DataFrame) -> DataFrame:
    """(group..., _rank, _v): the value of each wanted 1-based rank.

    ``counts``: a written table (group..., _v, _n) of distinct values (no NaN); ``wanted``: (group..., _rank).
    """
    groups = list(group_cols)
    spans = _renamed(counts.groupBy(*groups).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi")), groups, "_s_")
    state = wanted.join(spans, _same(wanted, spans, groups, "_s_")).select(*groups, "_rank", F.col("_rank").alias("_k"), "_lo", "_hi")
    state, scaled = stable_table(state, "ranks"), False
    while not (open_ := state.where(F.col("_lo") < F.col("_hi"))).isEmpty():
        ranges = _renamed(open_, groups, "_s_")
        inside = counts.join(ranges, _same(counts, ranges, groups, "_s_") & F.col("_v").between(F.col("_lo"), F.col("_hi")))
        keys = [*groups, "_rank", "_k"]
        pieces = inside.groupBy(*keys, _piece(F.col("_v"), F.col("_lo"), F.col("_hi"), scaled).alias("_piece")).agg(
            F.sum("_n").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        upto = Window.partitionBy(*groups, "_rank").orderBy("_piece")
        found = pieces.withColumn("_upto", F.sum("_n").over(upto)).withColumn("_k", F.col("_k") - (F.col("_upto") - F.col("_n")))
        found = found.where(F.col("_k").between(1, F.col("_n"))).select(*keys, "_lo", "_hi")
        state = stable_table(found.unionByName(state.where(F.col("_lo") == F.col("_hi"))), "ranks")
        scaled = not scaled
    return state.select(*groups, "_rank", F.col("_lo").alias("_v"))


def digest_thresholds(rows: DataFrame, class_col: str, digest: Column, ranks: Callable[[Column], Sequence[Column]]) -> DataFrame:
    """(_class, _size, _t0, _t1, ...): per class the shortest digest prefix up to which exactly so many rows lie.

    ``ranks`` gives the wanted ranks from the class size. A row is among them if its digest's beginning, of the threshold's
    length, is not greater; a rank of 0 gives a null threshold. Rows of one digest stay together, so where repeated digests
    lie across a rank all of them are within.
    """
    digests = rows.select(F.col(class_col).alias("_class"), digest.alias("_d"))
    first = stable_table(digests.groupBy("_class", F.left("_d", F.lit(DIGITS)).alias("_prefix")).agg(F.count(F.lit(1)).alias("_n")),
                         "digest-counts")
    sizes = first.groupBy("_class").agg(F.sum("_n").alias("_size"))
    want = ranks(F.col("_size"))
    targets = sizes.select("_class", F.posexplode(F.array(*[w.cast("bigint") for w in want])).alias("_q", "_k")).where(F.col("_k") > 0)
    ranges = _renamed(targets, ["_class"], "_s_")
    counted = first.join(ranges, _same(first, ranges, ["_class"], "_s_")).select("_class", "_q", "_k", "_prefix", "_n")
    state, length = stable_table(_within(counted), "thresholds"), DIGITS
    while not (open_ := state.where((F.col("_k") < F.col("_n")) & F.lit(length < 32))).isEmpty():
        ranges = open_.select(F.col("_class").alias("_s__class"), "_q", "_k", F.col("_prefix").alias("_p"))
        inside = digests.join(ranges, _same(digests, ranges, ["_class"], "_s_") & (F.left("_d", F.lit(length)) == F.col("_p")))
        length += DIGITS
        counted = inside.groupBy("_class", "_q", "_k", F.left("_d", F.lit(length)).alias("_prefix")).agg(F.count(F.lit(1)).alias("_n"))
        state = stable_table(_within(counted).unionByName(state.where(F.col("_k") == F.col("_n"))), "thresholds")
    chosen = [F.max(F.when(F.col("_q") == i, F.col("_prefix"))).alias(f"_t{i}") for i in range(len(want))]
    found = _renamed(state.groupBy("_class").agg(*chosen), ["_class"], "_s_")
    return stable_table(sizes.join(found, _same(sizes, found, ["_class"], "_s_"), "left").drop("_s__class"), "thresholds")


def _within(counted: DataFrame) -> DataFrame:
    """Of the counted prefixes of each target the one that holds its rank, and the rank within it."""
    upto = Window.partitionBy("_class", "_q").orderBy("_prefix")
    at = counted.withColumn("_upto", F.sum("_n").over(upto)).withColumn("_k", F.col("_k") - (F.col("_upto") - F.col("_n")))
    return at.where(F.col("_k").between(1, F.col("_n"))).select("_class", "_q", "_k", "_prefix", "_n")


def within(digest: Column, threshold: Column) -> Column:
    return F.coalesce(F.left(digest, F.length(threshold)) <= threshold, F.lit(False))
