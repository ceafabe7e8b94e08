"""Profiling and data-quality aggregates (map-side combined, skew-safe)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import char_length, word_count
from lectern.labels import SHORT_BODY_CHARS


def table_metadata(df: DataFrame) -> DataFrame:
    """(column_name, column_type, ordinal, n_rows): schema as rows + a row count."""
    fields = [F.struct(F.lit(f.name).alias("column_name"),
                       F.lit(f.dataType.simpleString()).alias("column_type"),
                       F.lit(i + 1).cast("bigint").alias("ordinal"))
              for i, f in enumerate(df.schema.fields)]
    return (df.agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.inline(F.array(*fields)), "n_rows"))


def class_distribution(df: DataFrame, class_col: str = "category") -> DataFrame:
    return df.groupBy(class_col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), class_col)


def text_length_profile(df: DataFrame, class_col: str = "category", body_col: str = "body") -> DataFrame:
    return df.groupBy(class_col).agg(
        F.round(F.avg(char_length(body_col)), 6).alias("avg_chars"),
        F.max(char_length(body_col)).alias("max_chars"),
        F.min(char_length(body_col)).alias("min_chars"),
        F.round(F.avg(word_count(body_col)), 6).alias("avg_words"),
    )


def word_count_rows(df: DataFrame, class_col: str = "category", body_col: str = "body") -> DataFrame:
    return df.select("doc_id", class_col, word_count(body_col).alias("word_count"))


def quality_counts(df: DataFrame, body_col: str = "body", title_col: str = "title",
                   class_col: str = "category", short: int = SHORT_BODY_CHARS) -> DataFrame:
    return df.agg(
        F.count_if(F.col(body_col).isNull()).alias("null_body"),
        F.count_if(F.col(title_col).isNull()).alias("null_title"),
        F.count_if(F.col(class_col).isNull()).alias("null_category"),
        F.count_if(F.length(body_col) < short).alias("short_body"),
        F.count(F.lit(1)).alias("total_rows"),
    )


def distinct_categories(df: DataFrame, class_col: str = "category") -> DataFrame:
    return df.select(class_col).distinct()
