"""Batch scoring with a user's own model.

``predict_batch_udf`` loads the model once per Python worker (the factory
runs lazily and is cached) and feeds it Arrow batches of at most
``batch_size`` rows, which bounds memory as the reference's mini-batches do.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from lectern.functions.scores import argmax_label, decode_label, pick, softmax


def score_external_model(df: DataFrame, make_predict_fn: Callable, input_col: str, width: int,
                         class_names: Sequence[str], batch_size: int = 32, key_col: str = "doc_id",
                         keep: Sequence[str] = ()) -> DataFrame:
    """``make_predict_fn() -> fn(ndarray[n, width]) -> ndarray[n, classes]`` of class scores.

    Softmax, argmax and confidence are then computed JVM-side.
    """
    udf = predict_batch_udf(make_predict_fn, return_type=ArrayType(DoubleType()), batch_size=batch_size,
                            input_tensor_shapes=[[width]])
    scored = df.select(key_col, *keep, udf(F.col(input_col)).alias("z"))
    scored = scored.withColumn("probs", softmax("z")).withColumn("pred", argmax_label("z"))
    return scored.withColumn("predicted_label", decode_label("pred", class_names)) \
                 .withColumn("confidence", pick("probs", "pred"))
