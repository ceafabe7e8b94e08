"""JSON batch requests and responses, as DataFrame columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REQUEST_SCHEMA = "struct<instances: array<struct<text: string>>>"


def request_json(requests: DataFrame, request_col: str = "request",
                 id_cols: Sequence[str] = ("conv_id", "chunk")) -> tuple[DataFrame, DataFrame]:
    """Parse ``{"instances":[{"text":..}]}``. Returns (rows, rejected).

    rows: (ids..., pos, text) with pos the 0-based input position;
    rejected: (ids..., reason) for unparsable requests, empty instance lists and instances without a text; a request
    is taken or rejected as a whole.
    """
    parsed = requests.select(*id_cols, F.from_json(F.col(request_col), REQUEST_SCHEMA).alias("_r"))
    inst = F.col("_r.instances")
    reason = F.when(inst.isNull(), "malformed request").when(F.size(inst) == 0, "instances list is empty") \
        .when(F.exists(inst, lambda i: i["text"].isNull()), "instance without text")
    rows = parsed.where(reason.isNull()).select(*id_cols, F.posexplode(inst).alias("pos", "_i")) \
        .select(*id_cols, F.col("pos").cast("bigint").alias("pos"), F.col("_i.text").alias("text"))
    rejected = parsed.select(*id_cols, reason.alias("reason")).where("reason IS NOT NULL")
    return rows, rejected


def response_json(scored: DataFrame, class_names: Sequence[str],
                  id_cols: Sequence[str] = ("conv_id", "chunk"), pos_col: str = "pos") -> DataFrame:
    """One ``{"predictions":[{label, confidence, scores}]}`` per request, input
    order kept, values rounded to 4 places. Each request is a bounded batch."""
    names = F.array(*[F.lit(c) for c in class_names])
    item = F.struct(
        F.col(pos_col).alias("pos"),
        F.col("predicted_label").alias("label"),
        F.round("confidence", 4).alias("confidence"),
        F.map_from_arrays(names, F.transform("probs", lambda p: F.round(p, 4))).alias("scores"))
    by_pos = lambda a, b: (a["pos"] - b["pos"]).cast("int")
    grouped = scored.groupBy(*id_cols).agg(F.array_sort(F.collect_list(item), by_pos).alias("_p"))
    preds = F.transform("_p", lambda s: F.struct(s["label"].alias("label"), s["confidence"].alias("confidence"),
                                                 s["scores"].alias("scores")))
    return grouped.select(*id_cols, F.to_json(F.struct(preds.alias("predictions"))).alias("response"))


def response_rows(responses: DataFrame, class_names: Sequence[str], response_col: str = "response",
                  id_cols: Sequence[str] = ("conv_id", "chunk")) -> DataFrame:
    """The predictions of each response as rows: (ids..., pos, label, confidence, score_<class>...)."""
    schema = "struct<predictions: array<struct<label: string, confidence: double, scores: map<string, double>>>>"
    parsed = responses.select(*id_cols, F.from_json(response_col, schema)["predictions"].alias("_p"))
    return parsed.select(*id_cols, F.posexplode("_p").alias("pos", "_i")).select(
        *id_cols, F.col("pos").cast("bigint").alias("pos"), "_i.label", "_i.confidence",
        *[F.col("_i.scores")[c].alias(f"score_{c}") for c in class_names])
