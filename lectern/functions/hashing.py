"""Deterministic hashing that gives the same numbers in Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def fingerprint(col: Column | str) -> Column:
    """Unsigned 32-bit fingerprint: the first 8 hex digits of md5."""
    return F.conv(F.substring(F.md5(_c(col).cast("string")), 1, 8), 16, 10).cast("bigint")


def abs_mod(col: Column | str, n: int) -> Column:
    """``MOD(ABS(x), n)`` without the overflow of ``abs`` on the minimum long."""
    return F.pmod(_c(col), F.lit(n))


def hash_pct(col: Column | str, digest=fingerprint) -> Column:
    """Bucket 0..99 of a value, stable across runs and engines: ``abs(digest) mod 100`` (of a signed digest, too)."""
    return F.abs(digest(_c(col).cast("string")) % 100)


def seeded_order_key(seed: int | str, key: Column | str) -> Column:
    """Random-looking but reproducible sort key: md5(seed || key)."""
    return F.md5(F.concat(F.lit(str(seed)), _c(key).cast("string")))
