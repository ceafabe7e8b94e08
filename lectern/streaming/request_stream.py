"""Answer prediction requests that arrive as files, each once; what cannot be answered goes to a second output.

A request file holds one JSON request a line: its id fields beside ``{"instances":[{"text":..}]}``. Every micro-batch writes
its responses and its rejects to folders of its query id and batch number, with overwrite: a batch replayed after a failure
replaces both, and a stream with another checkpoint adds to them.

Defined cases: a line that is no JSON, or lacks an id field, is rejected with NULL ids; so are, with their ids, empty instance
lists and instances without a text. Equal lines of one batch are answered once; several different lines under one id give one
reject without its lines (NULL request), as no answer could be told from another. Blank lines are passed over. A batch without requests writes no rows.
"""

from __future__ import annotations

import os
import threading
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lectern.operators import naive_bayes
from lectern.sources.requests import request_json, response_json

REJECT_COLUMNS = ["file", "request", "reason"]


def split_requests(lines: DataFrame, ids: StructType) -> tuple[DataFrame, DataFrame]:
    """(instances, rejects) of request lines (value, file): rows (ids..., pos, text) and rows (ids..., file, request, reason)."""
    names = ids.fieldNames()
    given = F.from_json("value", ids)
    keyed = lines.where(F.trim("value") != "").select(
        *[given[n].alias(n) for n in names], F.col("value").alias("request"), "file")
    known = reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])
    unknown = keyed.where(~known).withColumn("reason", F.lit("request without id"))
    # a group holds the lines of one id: only their extremes are kept, so repeats of one line need no memory
    once = keyed.where(known).groupBy(*names).agg(
        F.min("request").alias("request"), F.max("request").alias("_last"), F.min("file").alias("file"))
    clear = once.where("request = _last").drop("_last")
    twice = once.where("request <> _last").select(*names, "file", F.lit(None).cast("string").alias("request"),
                                                  F.lit("id used for different requests").alias("reason"))
    rows, bad = request_json(clear, id_cols=[*names, "file", "request"])
    columns = [*names, *REJECT_COLUMNS]
    return (rows.select(*names, "pos", "text"),
            unknown.select(*columns).unionByName(twice.select(*columns)).unionByName(bad.select(*columns)))


def stream_requests(spark: SparkSession, source_dir: str, model: naive_bayes.NaiveBayesModel, response_dir: str,
                    reject_dir: str, checkpoint_dir: str, ids: str = "conv_id long, chunk long",
                    max_files: int | None = None):
    """Answer all request files that have arrived; returns the finished query."""
    id_schema = StructType.fromDDL(ids)
    names = id_schema.fieldNames()
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.text(source_dir).select("value", F.col("_metadata.file_name").alias("file"))
    started, query_ids = threading.Event(), []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        slot = os.path.join(f"query_id={query_ids[0]}", f"batch_id={batch_id}")
        batch.persist()  # read for the answers and for the rejects
        try:
            rows, rejects = split_requests(batch, id_schema)
            scored = naive_bayes.score_nb(model, rows, key_col=[*names, "pos"])
            response_json(scored, model.class_names, id_cols=names).write.mode("overwrite").parquet(
                os.path.join(response_dir, slot))
            rejects.write.mode("overwrite").parquet(os.path.join(reject_dir, slot))
        finally:
            batch.unpersist()

    query = (lines.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_dir)
             .trigger(availableNow=True).start())
    query_ids.append(query.id)  # kept in the checkpoint: the same after a restart
    started.set()
    query.awaitTermination()
    return query
