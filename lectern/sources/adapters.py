"""Prediction-, history- and request-shaped views over the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.scores import argmax_label, decode_label, pick, softmax
from lectern.labels import TOPIC_CLASSES
from lectern.sources.tables import read_table

PREDICTION_EPOCH = dt.date(2024, 1, 1)
LOGIT_WIDTH = 5
ROUND = 6


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, z (first 5 embedding values x 10, double), y = label mod 5."""
    e = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding", "label"])
    return e.select(
        F.col("vec_id").alias("doc_id"),
        F.transform(F.slice("embedding", 1, LOGIT_WIDTH), lambda x: x.cast("double") * 10).alias("z"),
        F.pmod(F.col("label"), F.lit(LOGIT_WIDTH)).cast("bigint").alias("y"),
    )


def scored_logits(lg: DataFrame) -> DataFrame:
    """Add probs, predicted id and confidence to a logits frame."""
    return (
        lg.withColumn("probs", softmax("z"))
        .withColumn("pred", argmax_label("z"))
        .withColumn("confidence", pick("probs", "pred"))
    )


def predictions(spark: SparkSession, sf_dir: str, classes=TOPIC_CLASSES) -> DataFrame:
    """Prediction table: one row per scored document with a date and per-class scores."""
    s = scored_logits(logits(spark, sf_dir))
    cols = [
        "doc_id",
        F.date_add(F.lit(PREDICTION_EPOCH), F.pmod(F.col("doc_id"), F.lit(30)).cast("int")).alias("prediction_date"),
        decode_label("y", classes).alias("true_label"),
        decode_label("pred", classes).alias("predicted_label"),
        F.round("confidence", ROUND).alias("confidence"),
    ]
    cols += [F.round(F.col("probs")[i], ROUND).alias(f"score_{c}") for i, c in enumerate(classes)]
    cols += [(F.col("y") == F.col("pred")).alias("correct")]
    return s.select(*cols)


def metric_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long run history (run, step, key, value) derived from events.

    Aggregates per (event_type, day) first, so the step numbering window only
    sees runs x days rows.
    """
    ev = read_table(spark, sf_dir, "events", ["ts", "event_type", "value"])
    per_day = ev.groupBy(F.col("event_type").alias("run"), F.to_date("ts").alias("day")).agg(
        F.round(F.avg(F.when(F.col("value") > 20, 1.0).otherwise(0.0)), ROUND).alias("val_acc"),
        F.round(F.avg(F.when(F.col("value") > 15, 1.0).otherwise(0.0)), ROUND).alias("train_acc"),
        F.round(F.avg("value"), ROUND).alias("val_loss"),
        F.round(F.avg(F.col("value") * 0.9), ROUND).alias("train_loss"),
    )
    from pyspark.sql import Window

    stepped = per_day.withColumn(
        "step", F.dense_rank().over(Window.partitionBy("run").orderBy("day")).cast("bigint"))
    return stepped.unpivot(["run", "step"], ["train_loss", "train_acc", "val_loss", "val_acc"],
                           "key", "value")


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    return docs.join(lab, "doc_id", "inner")


def request_batches(spark: SparkSession, sf_dir: str, max_instances: int = 256) -> DataFrame:
    """One JSON request ``{"instances":[{"text":..}]}`` per conversation chunk.

    Turns are cut into chunks of at most ``max_instances`` so no request
    grows with a hot conversation.
    """
    c = read_table(spark, sf_dir, "conversations", ["conv_id", "turn", "text"])
    chunked = c.withColumn("chunk", F.floor(F.col("turn") / max_instances).cast("bigint"))
    grouped = chunked.groupBy("conv_id", "chunk").agg(
        F.sort_array(F.collect_list(F.struct("turn", "text"))).alias("turns"))
    return grouped.select(
        "conv_id", "chunk",
        F.to_json(F.struct(F.transform("turns", lambda t: F.struct(t["text"].alias("text"))).alias("instances")))
        .alias("request"),
    )
