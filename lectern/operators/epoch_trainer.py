"""Mini-batch training of a linear classifier over epochs, with validation, early stopping and a metric history.

Texts become hashed token counts (``num_features`` slots, rows of unit length), written once. An epoch deals the rows into
mini-batches by a keyed permutation of their numbers (``epoch_order``) and writes them by batch. A step reads its batch alone,
computes gradients in the tasks, adds them up inside each task and then by slot in a shuffle, and the driver, which holds the
parameters (``num_features`` x classes, a bound the caller sets), applies clipping, moment estimates, decoupled weight decay
and a rate that warms up and then falls linearly. After each epoch the validation rows are scored, the state is written, and
training stops when accuracy has not risen for ``patience`` epochs; the best epoch's parameters are the model.

Sums of gradients and losses are sums of whole numbers (multiples of 2**-36), so they do not depend on how rows lie in tasks:
two runs of one seed agree to the last bit whatever the number of partitions. A run resumes from its last written epoch.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.scores import argmax_label, decode_label, pick, softmax
from lectern.labels import SEED
from lectern.operators.encode import tokens
from lectern.operators.epoch_order import epoch_places
from lectern.operators.numbering import exact_row_number
from lectern.operators.sizing import drop_folder, stable_table
from lectern.session import ensure_checkpoint_dir

UNIT = float(1 << 36)
SLICE_ROWS = 2000
LOSS, ROWS, RIGHT = -1, -2, -3


@dataclass(frozen=True)
class TrainConfig:
    epochs: int = 5
    batch_size: int = 8
    lr: float = 0.05
    warmup_steps: int = 0
    weight_decay: float = 0.01
    patience: int = 3
    clip_norm: float = 1.0
    num_features: int = 1 << 16
    seed: int = SEED
    files_a_batch: int = 1


@dataclass
class EpochModel:
    weights: np.ndarray  # (num_features + 1, classes); the last row is the bias
    class_names: list[str]

    def save(self, spark: SparkSession, path: str) -> None:
        _write_state(spark, os.path.join(path, "weights"), [self.weights])
        meta = json.dumps({"class_names": self.class_names, "rows": len(self.weights)})
        spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").json(os.path.join(path, "meta"))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> EpochModel:
        meta = json.loads(spark.read.json(os.path.join(path, "meta")).first()["meta"])
        return cls(_read_state(spark, os.path.join(path, "weights"), 1, (meta["rows"], len(meta["class_names"])))[0], meta["class_names"])


def hashed_features(df: DataFrame, num_features: int, text_col: str = "text") -> DataFrame:
    """Add ``slots``: the sorted slots of all tokens, repeated as often as they occur."""
    t = F.coalesce(tokens(text_col), F.array().cast("array<string>"))
    return df.withColumn("slots", F.sort_array(F.transform(t, lambda x: F.pmod(F.xxhash64(x), F.lit(num_features)))))


def _entries(slots: pa.Array, num_features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, value, first entry of each row) of unit-length rows, each closed by the bias slot of value 1."""
    sizes = np.diff(slots.offsets.to_numpy()) + 1
    ends = np.cumsum(sizes)
    flat = np.full(int(ends[-1]), num_features, np.int64)
    inside = np.ones(len(flat), bool)
    inside[ends - 1] = False
    flat[inside] = slots.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sizes)), sizes)
    start = np.flatnonzero(np.r_[True, (np.diff(flat) != 0) | (np.diff(row) != 0)])
    count = np.diff(np.r_[start, len(flat)]).astype(np.float64)
    row, slot = row[start], flat[start]
    bias = slot == num_features
    first = np.flatnonzero(np.r_[True, np.diff(row) != 0])
    norm = np.sqrt(np.add.reduceat(np.where(bias, 0.0, count * count), first))
    value = np.where(bias, 1.0, count / np.where(norm == 0, 1.0, norm)[row])
    return row, slot, value, first


def _logits(weights: np.ndarray, row, slot, value, first) -> np.ndarray:
    return np.add.reduceat(value[:, None] * weights[slot], first, axis=0)


def _losses(z: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(probabilities, cross-entropy of each row, whether the first largest score is the label's)."""
    top = z.max(axis=1, keepdims=True)
    e = np.exp(z - top)
    total = e.sum(axis=1)
    return e / total[:, None], np.log(total) + top[:, 0] - z[np.arange(len(y)), y], z.argmax(axis=1) == y


def _whole(x: np.ndarray) -> np.ndarray:
    return np.rint(x * UNIT).astype(np.int64)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(i, SLICE_ROWS)


def batch_gradient(rows: DataFrame, weights, num_features: int) -> DataFrame:
    """(slot, total): summed gradients by slot (feature x classes + class), and the batch's loss, rows and right answers.

    ``weights`` is a broadcast variable of the parameters.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        total, seen = np.zeros(w.size, np.int64), np.zeros(3, np.int64)
        for batch in _slices(batches):
            y = batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
            row, slot, value, first = _entries(batch.column("slots"), num_features)
            probs, loss, right = _losses(_logits(w, row, slot, value, first), y)
            probs[np.arange(len(y)), y] -= 1.0
            part = _whole(value[:, None] * probs[row])
            order = np.argsort(slot, kind="stable")
            begin = np.flatnonzero(np.r_[True, np.diff(slot[order]) != 0])
            total.reshape(w.shape)[slot[order][begin]] += np.add.reduceat(part[order], begin, axis=0)
            seen += [_whole(loss).sum(), len(y), right.sum()]
        at = np.flatnonzero(total)
        if seen[1]:
            yield pa.RecordBatch.from_arrays([pa.array(np.r_[at, LOSS, ROWS, RIGHT]), pa.array(np.r_[total[at], seen])], names=["slot", "total"])

    return rows.select("label", "slots").mapInArrow(run, "slot long, total long").groupBy("slot").agg(F.sum("total").alias("total"))


def evaluate_rows(rows: DataFrame, weights, num_features: int, batch_size: int) -> tuple[float, float]:
    """(mean of the mini-batches' mean losses, accuracy) of numbered rows under a broadcast of parameters."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            y = batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
            _, loss, right = _losses(_logits(weights.value, *_entries(batch.column("slots"), num_features)), y)
            yield pa.RecordBatch.from_arrays([pa.array(batch.column("row").to_numpy() // batch_size), pa.array(_whole(loss)),
                                              pa.array(right.astype(np.int64))], names=["batch", "loss", "right"])

    scored = rows.select("row", "label", "slots").mapInArrow(run, "batch long, loss long, right long")
    per_batch = scored.groupBy("batch").agg((F.sum("loss") / F.count(F.lit(1))).alias("mean"), F.sum("right").alias("right"), F.count(F.lit(1)).alias("n"))
    got = per_batch.agg(F.sum(F.round("mean").cast("bigint")).alias("loss"), F.sum("right").alias("right"), F.sum("n").alias("n"),
                        F.count(F.lit(1)).alias("batches")).first()
    return (got["loss"] / UNIT / got["batches"], got["right"] / got["n"]) if got["n"] else (0.0, 0.0)


class Optimiser:
    """Moment estimates with bias correction, decoupled weight decay, clipping by norm, linear warm-up and fall."""

    def __init__(self, shape: tuple[int, int], config: TrainConfig, total_steps: int):
        self.w, self.m, self.v = (np.zeros(shape) for _ in range(3))
        self.config, self.total_steps, self.t = config, total_steps, 0

    def rate(self, t: int) -> float:
        warm = self.config.warmup_steps
        if t < warm:
            return self.config.lr * t / warm
        return self.config.lr * max(0.0, (self.total_steps - t) / max(1, self.total_steps - warm))

    def step(self, gradient: np.ndarray) -> None:
        norm = float(np.sqrt((gradient * gradient).sum()))
        if norm > self.config.clip_norm:
            gradient = gradient * (self.config.clip_norm / norm)
        rate = self.rate(self.t)
        self.t += 1
        self.m = 0.9 * self.m + 0.1 * gradient
        self.v = 0.999 * self.v + 0.001 * gradient * gradient
        unbiased = self.m / (1 - 0.9 ** self.t) / (np.sqrt(self.v / (1 - 0.999 ** self.t)) + 1e-8)
        self.w = self.w * (1 - rate * self.config.weight_decay) - rate * unbiased


def _write_state(spark: SparkSession, path: str, arrays: Sequence[np.ndarray]) -> None:
    used = np.flatnonzero(np.any([(a != 0).any(axis=1) for a in arrays], axis=0))
    # lists of Python floats: without Arrow Spark takes no numpy values
    frame = pd.DataFrame({"slot": used, **{f"a{i}": a[used].tolist() for i, a in enumerate(arrays)}})
    schema = "slot long, " + ", ".join(f"a{i} array<double>" for i in range(len(arrays)))
    spark.createDataFrame(frame, schema).write.mode("overwrite").parquet(path)


def _read_state(spark: SparkSession, path: str, n: int, shape: tuple[int, int]) -> list[np.ndarray]:
    out = [np.zeros(shape) for _ in range(n)]
    for r in spark.read.parquet(path).collect():  # at most as many rows as the parameters have
        for i in range(n):
            out[i][r["slot"]] = r[f"a{i}"]
    return out


class Run:
    """A training run's folder: a state and a line of figures for every finished epoch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def finished(self) -> list[dict]:
        try:
            lines = self.spark.read.json(os.path.join(self.path, "epochs")).collect()
        except AnalysisException:
            return []
        return sorted((json.loads(r["line"]) for r in lines), key=lambda d: d["epoch"])

    def finish(self, figures: dict, optimiser: Optimiser) -> None:
        """The state first, the line last: an epoch without its line is run again."""
        _write_state(self.spark, self.state(figures["epoch"]), [optimiser.w, optimiser.m, optimiser.v])
        self.spark.createDataFrame([(json.dumps(figures),)], "line string").coalesce(1).write.mode("append").json(
            os.path.join(self.path, "epochs"))

    def state(self, epoch: int) -> str:
        return os.path.join(self.path, "state", f"epoch={epoch}")


def _numbered(rows: DataFrame, class_names: Sequence[str], num_features: int, text_col: str, class_col: str, key_col: str) -> DataFrame:
    label = F.array_position(F.array(*[F.lit(c) for c in class_names]), F.col(class_col)) - 1
    featured = hashed_features(rows.select(key_col, text_col, label.cast("bigint").alias("label")).where(F.col("label") >= 0), num_features, text_col)
    order = [F.col(key_col).asc_nulls_first(), F.col("label").asc(), F.col("mix").asc()]
    ranked = exact_row_number(featured.select(key_col, "label", "slots", F.xxhash64("slots").alias("mix")), [], order, "row")
    return stable_table(ranked.select((F.col("row") - 1).alias("row"), "label", "slots"), "epoch-rows")


def train_epochs(train: DataFrame, val: DataFrame, class_names: Sequence[str], run_path: str, config: TrainConfig = TrainConfig(),
                 text_col: str = "text", class_col: str = "category", key_col: str = "doc_id") -> tuple[EpochModel, DataFrame]:
    """Train, validate after each epoch, stop early, restore the best epoch; returns (model, history of step, key, value).

    Rows of a class that ``class_names`` lacks are left out. If no epoch has a validation accuracy above 0 (no validation
    rows, for one), the last epoch's parameters are the model.
    """
    spark, names, size = train.sparkSession, list(class_names), config.num_features
    given = [_numbered(x, names, size, text_col, class_col, key_col) for x in (train, val)]
    n = given[0].count()
    steps = -(-n // config.batch_size)
    optimiser = Optimiser((size + 1, len(names)), config, steps * config.epochs)
    run = Run(spark, run_path)
    done = run.finished()
    if done:
        optimiser.w, optimiser.m, optimiser.v = _read_state(spark, run.state(done[-1]["epoch"]), 3, optimiser.w.shape)
        optimiser.t = done[-1]["steps"]
    while len(done) < config.epochs and not _stopped(done, config.patience):
        epoch = len(done) + 1
        losses, right = _train_epoch(given[0], n, epoch, steps, optimiser)
        weights = spark.sparkContext.broadcast(optimiser.w)
        val_loss, val_acc = evaluate_rows(given[1], weights, size, config.batch_size)
        weights.unpersist()
        figures = {"epoch": epoch, "steps": optimiser.t, "train_loss": sum(losses) / max(1, len(losses)), "train_acc": right / max(1, n),
                   "val_loss": val_loss, "val_acc": val_acc, **asdict(config)}
        run.finish(figures, optimiser)
        done.append(figures)
    best = _best_epoch(done)
    if best and best != done[-1]["epoch"]:
        optimiser.w = _read_state(spark, run.state(best), 3, optimiser.w.shape)[0]
    keys = ("train_loss", "train_acc", "val_loss", "val_acc")
    history = spark.createDataFrame([(d["epoch"], k, float(d[k])) for d in done for k in keys], "step long, key string, value double")
    return EpochModel(optimiser.w, names), history


def _train_epoch(rows: DataFrame, n: int, epoch: int, steps: int, optimiser: Optimiser) -> tuple[list[float], int]:
    """One pass in mini-batches; returns each batch's mean loss before its step, and the right answers."""
    spark, config = rows.sparkSession, optimiser.config
    placed = epoch_places(rows, n, epoch, config.batch_size, config.seed)
    dealt = placed.select("label", "slots", "batch", F.pmod("place", F.lit(config.files_a_batch)).alias("part"))
    path = os.path.join(ensure_checkpoint_dir(spark), "tables", f"epoch-batches-{uuid.uuid4().hex}")
    dealt.repartition("batch", "part").drop("part").write.partitionBy("batch").parquet(path)
    schema = dealt.select("label", "slots").schema
    losses, right = [], 0
    for b in range(steps):
        weights = spark.sparkContext.broadcast(optimiser.w)
        batch = spark.read.schema(schema).parquet(os.path.join(path, f"batch={b}"))
        got = batch_gradient(batch, weights, config.num_features).toPandas()
        weights.unpersist()
        slot, total = got["slot"].to_numpy(), got["total"].to_numpy()
        seen = dict(zip(slot[slot < 0].tolist(), total[slot < 0].tolist()))
        gradient = np.zeros(optimiser.w.size)
        gradient[slot[slot >= 0]] = total[slot >= 0] / UNIT / seen[ROWS]
        optimiser.step(gradient.reshape(optimiser.w.shape))
        losses.append(seen[LOSS] / UNIT / seen[ROWS])
        right += seen[RIGHT]
    drop_folder(spark, path)
    return losses, right


def _best_epoch(done: Sequence[dict]) -> int | None:
    best, epoch = 0.0, None
    for d in done:
        if d["val_acc"] > best:
            best, epoch = d["val_acc"], d["epoch"]
    return epoch


def _stopped(done: Sequence[dict], patience: int) -> bool:
    return len(done) - (_best_epoch(done) or 0) >= patience


def score_epochs(model: EpochModel, df: DataFrame, text_col: str = "text", key_col: str = "doc_id", keep: Sequence[str] = ()) -> DataFrame:
    """Adds z, probs (softmax), pred (argmax, lowest id on ties), predicted_label, confidence; a projection, no exchange."""
    weights, size = df.sparkSession.sparkContext.broadcast(model.weights), len(model.weights) - 1

    @F.arrow_udf("array<double>")
    def logits(slots: pa.Array) -> pa.Array:
        if not len(slots):
            return pa.array([], pa.list_(pa.float64()))
        return pa.array(list(_logits(weights.value, *_entries(slots, size))), pa.list_(pa.float64()))

    out = hashed_features(df, size, text_col).select(key_col, *keep, logits("slots").alias("z"))
    out = out.withColumn("probs", softmax("z")).withColumn("pred", argmax_label("z"))
    return out.withColumn("predicted_label", decode_label("pred", model.class_names)).withColumn("confidence", pick("probs", "pred"))
