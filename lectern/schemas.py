"""Fixed sink schemas (explicit, never inferred)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql.types import (BooleanType, DateType, DoubleType, LongType, StringType, StructField,
                               StructType, TimestampType)

SAMPLE_PREDICTION = StructType([
    StructField("doc_id", LongType()),
    StructField("title", StringType()),
    StructField("body", StringType()),
    StructField("category", StringType()),
    StructField("predicted_label", StringType()),
])

ARTICLE = StructType([
    StructField("doc_id", LongType()),
    StructField("title", StringType()),
    StructField("body", StringType()),
    StructField("category", StringType()),
])

METRIC_HISTORY = StructType([
    StructField("run", StringType()),
    StructField("step", LongType()),
    StructField("key", StringType()),
    StructField("value", DoubleType()),
])


def daily_prediction(classes: Sequence[str]) -> StructType:
    """The daily job's table: 13 columns for five classes (+ doc_id)."""
    return StructType(
        [StructField("prediction_date", DateType()),
         StructField("run_timestamp", TimestampType()),
         StructField("doc_id", LongType()),
         StructField("title", StringType()),
         StructField("body", StringType()),
         StructField("true_label", StringType()),
         StructField("predicted_label", StringType()),
         StructField("confidence", DoubleType())]
        + [StructField(f"score_{c}", DoubleType()) for c in classes]
        + [StructField("day_partition", LongType())])


def test_prediction(classes: Sequence[str], has_labels: bool = True) -> StructType:
    fields = [StructField("doc_id", LongType()), StructField("predicted", StringType()),
              StructField("confidence", DoubleType())]
    if has_labels:
        fields += [StructField("true_label", StringType()), StructField("correct", BooleanType())]
    return StructType(fields + [StructField(f"prob_{c}", DoubleType()) for c in classes])
