"""Keyed joins that replace the reference's positional pairing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators.sizing import bounded_broadcast, default_partitions, stable_table


def join_predictions(articles: DataFrame, preds: DataFrame, key_col: str = "doc_id") -> DataFrame:
    """Inner equi-join on the document key; AQE picks the strategy at run time."""
    return articles.join(preds, key_col, "inner")


def label_dict_frame(spark: SparkSession, mapping: Mapping[str, int]) -> DataFrame:
    rows = sorted(mapping.items(), key=lambda kv: kv[1])
    return spark.createDataFrame(rows, "category string, label bigint")


def join_label_dict(df: DataFrame, mapping: Mapping[str, int], class_col: str = "category") -> DataFrame:
    """Left join to the (size-known) label dictionary, broadcast."""
    d = label_dict_frame(df.sparkSession, mapping).withColumnRenamed("category", "_cat")
    d = bounded_broadcast(d, known_rows=len(mapping))
    return df.join(d, df[class_col] == d["_cat"], "left").drop("_cat")


# A key with more rows than a task's share, divided by this, is cut into pieces of that size.
FINENESS = 4


def hot_keys(facts: DataFrame, key: str, tasks: int) -> DataFrame:
    """(key, _pieces) of the keys that hold more than 1 / (FINENESS x tasks) of all rows, so at most FINENESS x tasks keys.

    Counted map-side; a key gets as many pieces as it has such shares.
    """
    counts = stable_table(facts.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), "key-counts")
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    share = max(1, total // (FINENESS * tasks))
    return counts.where(F.col("_n") > share).select(key, F.ceil(F.col("_n") / share).cast("long").alias("_pieces"))


def salted(facts: DataFrame, dim: DataFrame, key: str, salt_source: str | Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``_salt`` to join by: rows of a hot key are dealt over its pieces, its dimension row stands in each."""
    hot = F.broadcast(hot_keys(facts, key, default_partitions(facts)))  # bounded by the number of tasks
    source = [salt_source] if isinstance(salt_source, str) else salt_source or facts.columns
    src = F.struct(*[F.col(c) for c in source])
    pieces = F.coalesce("_pieces", F.lit(1).cast("long"))
    f = facts.join(hot, key, "left").withColumn("_salt", F.pmod(F.xxhash64(src), pieces)).drop("_pieces")
    d = dim.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), pieces - 1))).drop("_pieces")
    return f, d


def lookup_join(facts: DataFrame, dim: DataFrame, key: str, how: str = "left",
                salt_source: str | Sequence[str] | None = None) -> DataFrame:
    """Join a large fact table to a large dimension with one row per ``key`` by a shuffle.

    The facts are written once and their keys counted; rows of a key that would fill a task by itself (a token in a third of
    all rows) are dealt over as many pieces as its count asks for, by the hash of the ``salt_source`` columns (default the
    whole row), and only such keys' dimension rows are repeated.
    """
    f, d = salted(stable_table(facts, "facts"), dim, key, salt_source)
    return f.join(d, [key, "_salt"], how).drop("_salt")
