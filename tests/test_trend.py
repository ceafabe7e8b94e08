"""Streamed daily figures equal the batch figures of the latest runs after late files, reruns, replays and restarts."""

import datetime as dt
import os

import pytest

from lectern.operators.reports import performance_trend, recent_predictions
from lectern.streaming.trend import current_trend, run_sums, stream_run_sums

SCHEMA = "doc_id long, prediction_date date, day_partition int, run_timestamp timestamp, correct boolean, confidence double"
D1, D2 = dt.date(2024, 1, 1), dt.date(2024, 1, 9)
RUN1, RUN2 = dt.datetime(2024, 1, 1, 6), dt.datetime(2024, 1, 1, 9)


def rows(date, slot, run, marks):
    return [(i, date, slot, run, m, 0.25 + i / 8) for i, m in enumerate(marks)]


def figures(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def table(spark, tmp_path):
    class Table:
        src, sums, mark = (str(tmp_path / d) for d in ("src", "sums", "mark"))

        def arrive(self, data):
            spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(self.src)

        def run(self):
            return stream_run_sums(spark, self.src, spark.createDataFrame([], SCHEMA).schema, self.sums, self.mark, max_files=1)

        def trend(self, days=None):
            return current_trend(spark.read.parquet(self.sums), days)
    return Table()


def test_late_file_rerun_restart_and_replay(spark, table):
    table.arrive(rows(D1, 0, RUN1, [True, False]))
    table.arrive(rows(D2, 8, RUN1, [True]))
    table.run()
    late = rows(D1, 0, RUN1, [False])
    table.arrive(late)
    query = table.run()
    kept = rows(D1, 0, RUN1, [True, False]) + late + rows(D2, 8, RUN1, [True])
    assert figures(table.trend()) == figures(performance_trend(spark.createDataFrame(kept, SCHEMA)))
    table.arrive(rows(D1, 0, RUN2, [True, True, False]))  # the rerun of a day replaces it
    table.arrive(rows(D1, 3, RUN1, [None, True]))         # another slot of the day adds
    table.run()
    table.arrive(rows(D1, 0, RUN1, [False] * 5))          # too late: a newer run is there
    table.run()
    table.run()
    kept = spark.createDataFrame(rows(D1, 0, RUN2, [True, True, False]) + rows(D1, 3, RUN1, [None, True]) +
                                 rows(D2, 8, RUN1, [True]), SCHEMA)
    assert figures(table.trend()) == figures(performance_trend(kept))
    assert figures(table.trend(7)) == figures(performance_trend(recent_predictions(kept, 7)))
    # a replay writes the batch's folder again
    first = os.path.join(table.sums, f"query_id={query.id}", "batch_id=2")
    run_sums(spark.createDataFrame(late, SCHEMA), "prediction_date", "day_partition", "run_timestamp").write.mode(
        "overwrite").parquet(first)
    assert figures(table.trend()) == figures(performance_trend(kept))


def test_another_checkpoint_with_its_own_sums_starts_anew(spark, table):
    table.arrive(rows(D1, 0, RUN1, [True, False]))
    table.run()
    before = figures(table.trend())
    table.sums, table.mark = table.sums + "-new", table.mark + "-new"
    table.run()
    assert figures(table.trend()) == before


def test_no_rows_give_no_days(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert current_trend(run_sums(none, "prediction_date", "day_partition", "run_timestamp")).count() == 0
