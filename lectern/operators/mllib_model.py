"""MLlib text classifier: tokens -> hashed TF -> IDF -> multinomial logistic regression."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer, StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.scores import pick
from lectern.operators.sizing import stable_table


def build_pipeline(class_names: Sequence[str], text_col: str = "text", label_col: str = "category",
                   num_features: int = 1 << 18, max_iter: int = 50, reg: float = 0.0) -> Pipeline:
    """Class ids follow the given (alphabetical) dictionary, not label frequency."""
    indexer = StringIndexerModel.from_labels(list(class_names), inputCol=label_col, outputCol="label_idx",
                                             handleInvalid="skip")
    tok = RegexTokenizer(inputCol=text_col, outputCol="_tokens", pattern=r"[^\p{L}]+", toLowercase=True,
                         minTokenLength=1)
    tf = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features)
    idf = IDF(inputCol="_tf", outputCol="_features")
    lr = LogisticRegression(featuresCol="_features", labelCol="label_idx", family="multinomial",
                            maxIter=max_iter, regParam=reg)
    return Pipeline(stages=[indexer, tok, tf, idf, lr])


def train_mllib(train: DataFrame, class_names: Sequence[str], **kw) -> PipelineModel:
    """The pipeline fitted stage by stage: label ids and term counts, which need no fit, are written once, for the IDF and the
    regression would each split and hash all texts again."""
    *plain, idf, lr = build_pipeline(class_names, **kw).getStages()
    for stage in plain:
        train = stage.transform(train)
    counts = stable_table(train.select(idf.getInputCol(), lr.getLabelCol()), "term-counts")
    weights = idf.fit(counts)
    return PipelineModel([*plain, weights, lr.fit(weights.transform(counts))])


def objective_history(model: PipelineModel) -> list[float]:
    """Training loss per iteration (the run's metric history)."""
    return list(model.stages[-1].summary.objectiveHistory)


def score_mllib(model: PipelineModel, df: DataFrame, class_names: Sequence[str], key_col: str = "doc_id",
                keep: Sequence[str] = ()) -> DataFrame:
    """(key, keep..., probs, pred, predicted_label, confidence)."""
    out = model.transform(df)
    probs = vector_to_array(F.col("probability")).alias("probs")
    names = F.array(*[F.lit(c) for c in class_names])
    res = out.select(key_col, *keep, probs, F.col("prediction").cast("bigint").alias("pred"))
    return res.withColumn("predicted_label", F.element_at(names, (F.col("pred") + 1).cast("int"))) \
              .withColumn("confidence", pick("probs", "pred"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
