"""Footer statistics equal a scan's, and no data page is read."""

import datetime as dt
import os

from pyspark.sql import functions as F

from lectern.sources.footers import footer_counts, footer_extremes, footer_session, footer_statistics, table_bytes

SCHEMA = "k long, s string, d date, b boolean, x double, empty int, l array<int>, `odd name` int, t timestamp"
ROWS = [(1, "a", dt.date(2024, 1, 2), True, -1.5, None, [1], 7, dt.datetime(2024, 1, 1)),
        (5, None, dt.date(2023, 5, 6), None, 0.0, None, None, None, None),
        (None, "c", None, False, 2.5, None, [], 9, dt.datetime(2024, 1, 3))]


def stats(spark, path):
    return {r.column_name: r for r in footer_statistics(spark, path).collect()}


def test_rows_nulls_and_extremes_of_several_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(ROWS * 40, SCHEMA).repartition(5).write.parquet(path)
    got = stats(spark, path)
    assert {r.n_rows for r in got.values()} == {120}
    assert (got["k"].n_nulls, got["k"].min_value, got["k"].max_value) == (40, 1.0, 5.0)
    assert (got["s"].n_nulls, got["s"].min_value) == (40, None)
    assert (got["d"].min_value, got["d"].max_value) == ((dt.date(2023, 5, 6) - dt.date(1970, 1, 1)).days,
                                                        (dt.date(2024, 1, 2) - dt.date(1970, 1, 1)).days)
    assert (got["b"].n_nulls, got["b"].min_value, got["b"].max_value) == (40, 0.0, 1.0)
    assert (got["x"].min_value, got["x"].max_value) == (-1.5, 2.5)
    assert (got["empty"].n_nulls, got["empty"].min_value, got["empty"].max_value) == (120, None, None)
    assert (got["odd name"].n_nulls, got["odd name"].max_value) == (40, 9.0)
    assert got["l"].n_nulls is None and got["t"].n_nulls is None
    assert [r.ordinal for r in got.values()] == list(range(1, 10))


def test_nan_is_the_greatest(spark, tmp_path):
    path = str(tmp_path / "nan")
    spark.createDataFrame([(1.0,), (float("nan"),), (-0.0,)], "x double").write.parquet(path)
    got = stats(spark, path)["x"]
    assert got.min_value == 0.0 and got.max_value != got.max_value


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "e")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    got = stats(spark, path)
    assert all(r.n_rows == 0 and r.min_value is None and r.n_nulls in (0, None) for r in got.values())


def test_aggregates_are_pushed_and_the_callers_settings_stay(spark, sf_small, capsys):
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    path = os.path.join(sf_small, "documents.parquet")
    own = footer_session(spark)
    footer_counts(own.read.parquet(path)).explain("formatted")
    footer_extremes(own.read.parquet(path), [0, 4]).explain("formatted")
    plan = capsys.readouterr().out
    assert "PushedAggregation: [COUNT(*), COUNT(doc_id), COUNT(text)" in plan
    assert "PushedAggregation: [MIN(doc_id), MAX(doc_id), MIN(n_chars)" in plan
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    got = stats(spark, path)
    want = spark.read.parquet(path).agg(F.count("*"), F.min("n_chars"), F.max("n_chars")).first()
    assert (got["n_chars"].n_rows, got["n_chars"].min_value, got["n_chars"].max_value) == tuple(want)


def test_bytes_come_from_the_listing(spark, sf_small):
    path = os.path.join(sf_small, "documents.parquet")
    row = table_bytes(spark, path).first()
    assert (row.n_files, row.n_bytes) == (1, os.path.getsize(path))
