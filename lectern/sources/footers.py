"""Table statistics from Parquet footers: rows, nulls and extremes per column, and bytes, without a scan of the data.

The aggregates are pushed down into the scan, so each task answers for its files from their footers and only one row per
split is shuffled: the work grows with the number of row groups, not with the data. The push-down needs the version 2
Parquet reader; both are switched on in a session of their own, so the caller's settings stay as they are.

Rows and nulls are known for every flat column, extremes for whole numbers, floats, booleans and dates. For other types
(texts, whose footer extremes may be cut; timestamps; nested columns) the figure is NULL rather than a data scan. A footer
has no extremes for a row group of nulls only, nor where a float is NaN, and Spark then refuses the push-down. Columns with
nulls and floats are therefore asked apart, and if footers cannot answer for them, these columns alone are scanned.

An empty table gives 0 rows, 0 nulls and NULL extremes; a column of nulls only gives NULL extremes; NaN is the greatest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COUNTED = (T.NumericType, T.BooleanType, T.StringType, T.BinaryType, T.DateType)
RANGED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.BooleanType, T.DateType)


def footer_session(spark: SparkSession) -> SparkSession:
    """A session over the same context whose Parquet scans answer aggregates from footers."""
    own = spark.newSession()
    v1 = own.conf.get("spark.sql.sources.useV1SourceList").split(",")
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in v1 if s.strip() != "parquet"))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    return own


def _number(value, kind: T.DataType):
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    return value.cast("double") + F.lit(0.0)  # footers give a least zero as -0.0


def footer_counts(df: DataFrame) -> DataFrame:
    """One row: n, and n_<i> for the rows of the i-th column that are not null, as far as footers know them."""
    return df.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.col(f"`{f.name}`")).alias(f"n_{i}")
                                                  for i, f in enumerate(df.schema.fields) if isinstance(f.dataType, COUNTED)])


def footer_extremes(df: DataFrame, places: Sequence[int]) -> DataFrame:
    """One row: lo_<i> and hi_<i> of the columns at ``places``."""
    fields = df.schema.fields
    return df.agg(*[way(F.col(f"`{fields[i].name}`")).alias(f"{name}_{i}")
                    for i in places for name, way in (("lo", F.min), ("hi", F.max))]) \
        .select(*[_number(F.col(f"{name}_{i}"), fields[i].dataType).alias(f"{name}_{i}") for i in places for name in ("lo", "hi")])


def _extremes(spark: SparkSession, own: SparkSession, path: str, names: Sequence[str], places: Sequence[int]) -> dict:
    if not places:
        return {}
    try:
        return footer_extremes(own.read.parquet(path).select(*names), places).first().asDict()
    except Exception as e:  # the task's error arrives as a Java error
        if "No min/max found" not in str(e):
            raise
        return footer_extremes(spark.read.parquet(path).select(*names), places).first().asDict()


def footer_statistics(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(column_name, column_type, ordinal, n_rows, n_nulls, min_value, max_value) per column.

    Extremes are doubles: dates as days since 1970-01-01, booleans as 0 and 1; whole numbers beyond 2^53 are rounded. Two or
    three small jobs run at once; the result has one row per column.
    """
    own = footer_session(spark)
    df = own.read.parquet(path)
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    names = [f"`{f.name}`" for f in fields]
    counts = {k: v or 0 for k, v in footer_counts(df.select(*names)).first().asDict().items()}  # no row group, no count
    n = counts["n"]
    ranged = [i for i, f in enumerate(fields) if isinstance(f.dataType, RANGED)]
    sure = [i for i in ranged if counts[f"n_{i}"] == n and not isinstance(fields[i].dataType, T.FractionalType)]
    ends = {} if n == 0 else {**_extremes(spark, own, path, names, sure),
                              **_extremes(spark, own, path, names, [i for i in ranged if i not in sure and counts[f"n_{i}"]])}
    rows = [(f.name, f.dataType.simpleString(), i + 1, n, n - counts[f"n_{i}"] if f"n_{i}" in counts else None,
             ends.get(f"lo_{i}"), ends.get(f"hi_{i}")) for i, f in enumerate(fields)]
    return spark.createDataFrame(rows, "column_name string, column_type string, ordinal long, n_rows long, n_nulls long, "
                                       "min_value double, max_value double")


def table_bytes(spark: SparkSession, path: str) -> DataFrame:
    """(n_files, n_bytes) of a table's Parquet files, from the listing alone: the files' contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet") \
        .option("recursiveFileLookup", "true").load(path)
    return files.agg(F.count(F.lit(1)).alias("n_files"), F.coalesce(F.sum("length"), F.lit(0)).alias("n_bytes"))
