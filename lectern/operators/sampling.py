"""Deterministic sampling, top-k style picks and shuffles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.hashing import fingerprint, hash_pct, seeded_order_key
from lectern.functions.timefmt import sample_pct
from lectern.labels import SEED


def sample_hash_label(df: DataFrame, sample_size: int, total: int, label_col: str = "category",
                      digest=fingerprint) -> DataFrame:
    """As the reference writes it: hash of the *label*, so classes are kept or dropped whole."""
    pct = sample_pct(sample_size, total)
    return df.where(hash_pct(label_col, digest) < pct)


def sample_hash_row(df: DataFrame, sample_size: int, total: int, key_col: str = "doc_id",
                    digest=fingerprint) -> DataFrame:
    """About ``sample_size`` rows, the same rows on every run: hash of the row key."""
    pct = sample_pct(sample_size, total)
    return df.where(hash_pct(key_col, digest) < pct)


def random_sample_n(df: DataFrame, n: int, seed: int = SEED, key_col: str = "doc_id") -> DataFrame:
    """``ORDER BY RAND() LIMIT n`` made reproducible: top-n of md5(seed || key).

    Plans as TakeOrderedAndProject (per-partition top-n, no global sort).
    """
    return df.orderBy(seeded_order_key(seed, key_col), F.col(key_col)).limit(n)


def one_per_class(df: DataFrame, seed: int = SEED, class_col: str = "category",
                  key_col: str = "doc_id") -> DataFrame:
    """One pseudo-random row per class: the row with the smallest seeded hash.

    A ``min_by`` aggregate, so a large class is reduced map-side.
    """
    others = [c for c in df.columns if c != class_col]
    order_key = F.struct(seeded_order_key(seed, key_col), F.col(key_col))
    picked = df.groupBy(class_col).agg(F.min_by(F.struct(*others), order_key).alias("_row"))
    return picked.select(class_col, *[F.col("_row")[c].alias(c) for c in others])


def epoch_shuffle(df: DataFrame, epoch: int, key_col: str = "doc_id") -> DataFrame:
    """Training order for one epoch: md5(key || epoch), a new order each epoch."""
    return df.withColumn("epoch_order", F.md5(F.concat(F.col(key_col).cast("string"), F.lit(f"-{epoch}"))))


def limit_n(df: DataFrame, n: int, *order_cols) -> DataFrame:
    """First n rows under a defined order."""
    return df.orderBy(*order_cols).limit(n)
