"""Score newly arrived article files and append predictions exactly once.

The file source records processed files in the query checkpoint; each
micro-batch is scored with the static model tables and written to its own
``query_id=<id>/batch_id=<n>`` folder with overwrite, so a replayed batch after
a failure replaces its own output instead of duplicating it, and a stream with
another checkpoint (whose batches start at 0 again) never replaces this one's.
"""

from __future__ import annotations

import os
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lectern.operators import naive_bayes


def stream_score_append(spark: SparkSession, source_dir: str, schema: StructType,
                        model: naive_bayes.NaiveBayesModel, sink_dir: str, checkpoint_dir: str,
                        text_col: str = "body", keep=("title", "category"), max_files: int | None = None):
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    stream = reader.parquet(source_dir)
    started, ids = threading.Event(), []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        # scoring reads the batch twice (tokens, then the kept columns joined
        # back); the batch is held for the duration of this write only
        batch.persist()
        try:
            scored = naive_bayes.score_nb(model, batch, text_col=text_col, keep=list(keep))
            out = scored.select("doc_id", *keep, "predicted_label", F.round("confidence", 6).alias("confidence"))
            out.write.mode("overwrite").parquet(os.path.join(sink_dir, f"query_id={ids[0]}", f"batch_id={batch_id}"))
        finally:
            batch.unpersist()

    query = (stream.writeStream.foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint_dir)
             .trigger(availableNow=True).start())
    ids.append(query.id)  # kept in the checkpoint: the same after a restart
    started.set()
    query.awaitTermination()
    return query
