"""Run-history queries."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from lectern.labels import REPORT_CONFIG_ROWS
from lectern.operators import history as hist
from lectern.plans.registry import register
from lectern.plans.views import METRIC_HISTORY, with_
from lectern.session import ensure_checkpoint_dir
from lectern.sources.adapters import metric_history

ES_SQL = with_(METRIC_HISTORY) + """,
h AS (SELECT run, step, value, row_number() OVER (PARTITION BY run ORDER BY step) AS pos,
             value > greatest(0.0, coalesce(max(value) OVER (PARTITION BY run ORDER BY step
                                                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS imp
      FROM metric_history WHERE key = 'val_acc'),
h2 AS (SELECT *, pos - max(CASE WHEN imp THEN pos ELSE 0 END) OVER (PARTITION BY run ORDER BY step
                                                                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS no_improve
       FROM h),
st AS (SELECT run, coalesce(min(pos) FILTER (WHERE no_improve >= 3), max(pos)) AS stop_pos, max(pos) AS n FROM h2 GROUP BY run),
upto AS (SELECT h2.*, st.stop_pos, st.n FROM h2 JOIN st USING (run) WHERE pos <= stop_pos),
ranked AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY value DESC, step) AS r FROM upto),
es AS (SELECT run, CAST(max(step) FILTER (WHERE pos = stop_pos) AS BIGINT) AS stop_step, CAST(any_value(n) AS BIGINT) AS n_steps,
              CASE WHEN max(value) FILTER (WHERE imp) IS NULL THEN NULL ELSE CAST(max(step) FILTER (WHERE r = 1) AS BIGINT) END AS best_step,
              CASE WHEN max(value) FILTER (WHERE imp) IS NULL THEN NULL ELSE max(value) FILTER (WHERE r = 1) END AS best_value
       FROM ranked GROUP BY run)
"""


@register("metrics_read", with_(METRIC_HISTORY) + """
SELECT run, key, count(*) AS n_steps, arg_max(value, step) AS last_value,
       string_agg(CAST(step AS VARCHAR) || ':' || CAST(CAST(value AS DECIMAL(18, 6)) AS VARCHAR), ',' ORDER BY step) AS history
FROM metric_history GROUP BY run, key""")
def q_metrics_read(spark, sf):
    return hist.metrics_read(metric_history(spark, sf))


@register("early_stop", ES_SQL + "SELECT * FROM es")
def q_early_stop(spark, sf):
    return hist.early_stop(metric_history(spark, sf), 3)


@register("best_epoch", ES_SQL + "SELECT run, best_step, best_value FROM es")
def q_best_epoch(spark, sf):
    return hist.best_epoch(metric_history(spark, sf), 3)


@register("training_curves", with_(METRIC_HISTORY) + """
SELECT run, step, max(value) FILTER (WHERE key = 'train_loss') AS train_loss,
       max(value) FILTER (WHERE key = 'train_acc') AS train_acc,
       max(value) FILTER (WHERE key = 'val_loss') AS val_loss,
       max(value) FILTER (WHERE key = 'val_acc') AS val_acc
FROM metric_history GROUP BY run, step""")
def q_training_curves(spark, sf):
    return hist.training_curves(hist.require_history(metric_history(spark, sf)))


CONFIG_VALUES = ",\n".join(
    f"({i + 1}, '{name}', '{key}', '{default}')" for i, (name, key, default) in enumerate(REPORT_CONFIG_ROWS))


@register("report_config_rows", with_(METRIC_HISTORY) + f""",
cfg(position, parameter, param, dflt) AS (VALUES {CONFIG_VALUES}),
runs AS (SELECT DISTINCT run FROM metric_history),
params AS (SELECT run, 'epochs' AS param, CAST(max(step) AS VARCHAR) AS value FROM metric_history GROUP BY run)
SELECT r.run, CAST(c.position AS BIGINT) AS position, c.parameter, coalesce(p.value, c.dflt) AS value
FROM runs r CROSS JOIN cfg c LEFT JOIN params p ON p.run = r.run AND p.param = c.param""")
def q_report_config_rows(spark, sf):
    h = metric_history(spark, sf)
    return hist.report_config_rows(h, hist.run_params(h))


@register("metrics_append", with_(METRIC_HISTORY) + "SELECT run, step, key, value FROM metric_history")
def q_metrics_append(spark, sf):
    """Log the history in two appends (train keys, then val keys) and read the table back."""
    path = os.path.join(ensure_checkpoint_dir(spark), "tables", f"metrics-{uuid.uuid4().hex}")
    h = metric_history(spark, sf)
    hist.metrics_append(h.where(F.col("key").startswith("train")), path)
    hist.metrics_append(h.where(F.col("key").startswith("val")), path)
    return spark.read.parquet(path)
