"""Evaluation of scored rows: accuracy, confusion, reports, losses, histograms.

Inputs are long per-row frames with a true class id ``y``, a predicted id
``pred`` and a probability array ``probs``. Per-class numbers come from the
confusion grid (classes x classes rows), never from per-class windows over
the rows, so a dominant class does not land in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.scores import decode_label, pick, zero_divide
from lectern.operators.numbering import global_row_number
from lectern.operators.sizing import stable_table

ROUND = 6


def accuracy(df: DataFrame, flag: str = "correct") -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(flag)).alias("n_correct"),
        F.count_if(~F.col(flag)).alias("n_errors"),
        F.round(F.avg(F.col(flag).cast("double")), ROUND).alias("accuracy"),
    )


def class_grid(spark, classes: Sequence[str]) -> DataFrame:
    """All (true, predicted) id pairs of the dictionary, generated by a range."""
    c = len(classes)
    return spark.range(c * c).select(
        (F.col("id") / c).cast("bigint").alias("y"), F.pmod(F.col("id"), F.lit(c)).alias("pred"))


def confusion_counts(df: DataFrame, classes: Sequence[str], y: str = "y", pred: str = "pred") -> DataFrame:
    counts = df.groupBy(F.col(y).alias("y"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))
    # at most classes x classes rows, written once: reports read them several times, the scored rows are read only here
    counts = stable_table(counts, "confusion")
    grid = class_grid(df.sparkSession, classes)
    full = grid.join(counts, ["y", "pred"], "left")
    return full.select(
        decode_label("y", classes).alias("true_label"),
        decode_label("pred", classes).alias("predicted_label"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
        "y", "pred",
    )


def confusion_normalised(df: DataFrame, classes: Sequence[str], **kw) -> DataFrame:
    cm = confusion_counts(df, classes, **kw)
    row_total = F.sum("n").over(Window.partitionBy("y"))
    return cm.select("true_label", "predicted_label",
                     F.round(zero_divide(F.col("n"), row_total), ROUND).alias("share"))


def classification_report(df: DataFrame, classes: Sequence[str], null_safe: bool = False, **kw) -> DataFrame:
    """Per class precision, recall, F1, support; every class listed.

    Zero denominators give 0.0 (report convention) or NULL when ``null_safe``.
    """
    cm = confusion_counts(df, classes, **kw)
    per_true = cm.groupBy("y").agg(F.sum("n").alias("support"),
                                   F.sum(F.when(F.col("y") == F.col("pred"), F.col("n"))).alias("tp"))
    per_pred = cm.groupBy(F.col("pred").alias("y")).agg(F.sum("n").alias("predicted"))
    j = per_true.join(per_pred, "y")
    div = (lambda a, b: F.try_divide(a.cast("double"), b)) if null_safe else zero_divide
    j = j.withColumn("precision", div(F.col("tp"), F.col("predicted")))
    j = j.withColumn("recall", div(F.col("tp"), F.col("support")))
    f1 = div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    j = j.withColumn("f1_score", f1)
    return j.select(decode_label("y", classes).alias("label"),
                    F.round("precision", ROUND).alias("precision"),
                    F.round("recall", ROUND).alias("recall"),
                    F.round("f1_score", ROUND).alias("f1_score"),
                    F.col("support").cast("bigint").alias("support"))


def report_averages(report: DataFrame) -> DataFrame:
    """Macro avg, weighted avg (by support) and accuracy rows.

    ``report`` must hold unrounded or rounded per-class rows; accuracy is
    the support-weighted recall.
    """
    tot = F.sum("support")
    macro = report.agg(F.lit("macro avg").alias("label"),
                       F.avg("precision").alias("precision"), F.avg("recall").alias("recall"),
                       F.avg("f1_score").alias("f1_score"), tot.alias("support"))
    weighted = report.agg(F.lit("weighted avg").alias("label"),
                          *[zero_divide(F.sum(F.col(m) * F.col("support")), tot).alias(m)
                            for m in ["precision", "recall", "f1_score"]],
                          tot.alias("support"))
    acc = report.agg(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                     F.lit(None).cast("double").alias("recall"),
                     zero_divide(F.sum(F.col("recall") * F.col("support")), tot).alias("f1_score"),
                     tot.alias("support"))
    out = macro.unionByName(weighted).unionByName(acc)
    return out.select("label", *[F.round(m, ROUND).alias(m) for m in ["precision", "recall", "f1_score"]],
                      F.col("support").cast("bigint").alias("support"))


def full_report(df: DataFrame, classes: Sequence[str], **kw) -> DataFrame:
    """Per-class rows plus the three summary rows, with a ``kind`` column."""
    per = classification_report(df, classes, **kw)
    avg = report_averages(per)
    return (per.withColumn("kind", F.lit("class"))
            .unionByName(avg.withColumn("kind", F.lit("summary"))))


def report_long(report: DataFrame) -> DataFrame:
    """(label, metric, value) rows; NULL metrics dropped."""
    r = report.select("label", "precision", "recall", "f1_score", F.col("support").cast("double").alias("support"))
    return r.unpivot(["label"], ["precision", "recall", "f1_score", "support"], "metric", "value") \
        .where(F.col("value").isNotNull())


def mean_probs_by_class(df: DataFrame, classes: Sequence[str], y: str = "y", probs: str = "probs") -> DataFrame:
    return df.groupBy(decode_label(y, classes).alias("true_label")).agg(
        *[F.round(F.avg(F.col(probs)[i]), ROUND).alias(f"prob_{c}") for i, c in enumerate(classes)])


def histogram(df: DataFrame, value_col: str, bins: int = 20) -> DataFrame:
    """Equal-width bins between min and max (last bin closed) + overall mean.

    The range is one scalar aggregate read on the driver; all equal values
    widen the range by 0.5 on each side (so no division by zero).
    """
    x = F.col(value_col).cast("double")
    st = df.agg(F.min(x).alias("mn"), F.max(x).alias("mx"), F.avg(x).alias("mean")).first()
    if st is None or st["mn"] is None:
        return df.sparkSession.createDataFrame([], "bin bigint, bin_low double, bin_high double, n bigint, mean double")
    mn, mx, mean = float(st["mn"]), float(st["mx"]), float(st["mean"])
    if mn == mx:
        mn, mx = mn - 0.5, mx + 0.5
    width = (mx - mn) / bins
    b = F.least(F.floor((x - F.lit(mn)) / F.lit(width)), F.lit(bins - 1)).cast("bigint")
    counts = df.where(x.isNotNull()).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    all_bins = df.sparkSession.range(bins).withColumnRenamed("id", "bin")
    out = all_bins.join(F.broadcast(counts), "bin", "left")
    return out.select("bin",
                      F.round(F.lit(mn) + F.col("bin") * F.lit(width), ROUND).alias("bin_low"),
                      F.round(F.lit(mn) + (F.col("bin") + 1) * F.lit(width), ROUND).alias("bin_high"),
                      F.coalesce("n", F.lit(0)).cast("bigint").alias("n"),
                      F.round(F.lit(mean), ROUND).alias("mean"))


def mini_batch_id(df: DataFrame, batch_size: int, order_cols: Sequence, out_col: str = "batch") -> DataFrame:
    """Consecutive chunks of ``batch_size`` rows in a defined order."""
    n = global_row_number(df, order_cols, "_rn")
    return n.withColumn(out_col, F.floor((F.col("_rn") - 1) / batch_size).cast("bigint")).drop("_rn")


def _batch_losses(df: DataFrame, batch_size: int, y: str, pred: str | None, probs: str, key_col: str) -> DataFrame:
    ok = (F.col(y) == F.col(pred)).cast("bigint") if pred else F.lit(0).cast("bigint")
    if "z" in df.columns:  # cross-entropy from the scores: log-sum-exp(z) - z[y], exact where a probability rounds to 0
        top = F.array_max("z")
        total = F.aggregate("z", F.lit(0.0), lambda s, x: s + F.exp(x - top))
        loss = top + F.log(total) - pick("z", y)
    else:  # probabilities only: an exact 0 counts as the smallest normal double, so no row drops out
        loss = -F.log(F.greatest(pick(probs, y), F.lit(2.2250738585072014e-308)))
    rows = df.select(key_col, loss.alias("_loss"), ok.alias("_ok"))
    batched = mini_batch_id(rows, batch_size, [F.col(key_col).asc()])
    return batched.groupBy("batch").agg(F.avg("_loss").alias("_bl"), F.sum("_loss").alias("_s"),
                                        F.count(F.lit(1)).alias("_n"), F.sum("_ok").alias("_ok"))


def log_loss_batched(df: DataFrame, batch_size: int = 32, y: str = "y", probs: str = "probs",
                     key_col: str = "doc_id") -> DataFrame:
    """Cross-entropy: mean of per-batch means (as the training loop reports it),
    plus the plain row mean."""
    per_batch = _batch_losses(df, batch_size, y, None, probs, key_col)
    return per_batch.agg(
        F.round(F.avg("_bl"), ROUND).alias("loss_batched"),
        F.round(F.sum("_s") / F.sum("_n"), ROUND).alias("loss_rows"),
        F.count(F.lit(1)).alias("n_batches"),
        F.sum("_n").cast("bigint").alias("n_rows"),
    )


def evaluate_model(df: DataFrame, batch_size: int = 32, y: str = "y", pred: str = "pred",
                   probs: str = "probs", key_col: str = "doc_id") -> DataFrame:
    """Loss (batch-mean form) and accuracy of a scored split, one row."""
    per_batch = _batch_losses(df, batch_size, y, pred, probs, key_col)
    return per_batch.agg(
        F.round(F.avg("_bl"), ROUND).alias("loss"),
        F.round(F.sum("_ok") / F.sum("_n"), ROUND).alias("accuracy"),
        F.sum("_n").cast("bigint").alias("n_rows"),
    )
