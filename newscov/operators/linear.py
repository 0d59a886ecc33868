"""Logistic classifiers over hashed words, any number of them trained together.

A *head* is one classifier: a task (which label it predicts) with a penalty. One pass over the
training rows gives loss and gradient of all heads, so passes do not grow with the number of
tasks or penalties. Each head takes its own limited-memory quasi-Newton steps; one whose step did not lower its loss
tries half of it in the next pass, which the others use for a step of their own.

A task keeps one partial gradient, cuts it into slices of features and sends each slice to the
task that adds it up. What reaches the driver is one gradient: its size is that of the model,
``(features + 1) * heads`` doubles, and checked against ``MODEL_BYTES``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import newscov
from newscov.functions.text import clean_tokens
from newscov.operators.topics import with_word_counts
from newscov.scale import written

cloudpickle.register_pickle_by_value(newscov)

#: Largest model, and so the largest broadcast and the largest result a pass brings to the driver.
MODEL_BYTES = 512 << 20
#: Length every row of word weights is scaled to; it sets how strongly a given penalty shrinks.
ROW_LENGTH = 8.0
#: Steps remembered by the quasi-Newton method.
HISTORY = 6
#: Features of one gradient slice.
SLICE = 4096
#: Word entries a task works on at once.
ENTRIES = 1 << 20

_SLICES = "slice INT, block BINARY"


@dataclass
class LinearModel:
    """Weights of all heads, ``(features + 1, heads)`` with the intercepts last, and the features' document weights."""

    idf: np.ndarray
    weights: np.ndarray
    language: str

    @property
    def n_features(self) -> int:
        return len(self.idf)

    def only(self, heads: list[int]) -> LinearModel:
        return LinearModel(self.idf, np.ascontiguousarray(self.weights[:, heads]), self.language)


@dataclass
class Fit:
    """A model with the training loss of every head and the passes over the training rows it took."""

    model: LinearModel
    losses: np.ndarray
    passes: int


def with_features(texts: DataFrame, text: str, language: str, n_features: int) -> DataFrame:
    """Add ``_words``, the different clean words with their counts ``tf``, and ``_buckets``, their hashed numbers.

    Words of a row are counted within the row, without a shuffle. A null text has no words.
    """
    counted = with_word_counts(texts, "_words", text, language)
    return counted.withColumn("_buckets", buckets(F.col("_words"), n_features))


def buckets(words: Column, n_features: int) -> Column:
    hashed = F.transform(words, lambda w: F.pmod(F.xxhash64(w["word"]), F.lit(n_features)).cast("int"))
    return F.coalesce(hashed, F.array().cast("array<int>"))


def counts(words: Column) -> Column:
    return F.coalesce(F.transform(words, lambda w: w["tf"].cast("int")), F.array().cast("array<int>"))


def hashed_words(text: Column, language: str, n_features: int) -> Column:
    """The hashed number of every clean word of a text, as often as it occurs; none for a null text."""
    hashed = F.transform(clean_tokens(text, language), lambda w: F.pmod(F.xxhash64(w), F.lit(n_features)).cast("int"))
    return F.coalesce(hashed, F.array().cast("array<int>"))


def with_bucket_counts(texts: DataFrame, text: str, language: str, n_features: int) -> DataFrame:
    """Add ``_buckets``, the different hashed numbers of the clean words in order, and ``_tfs``, how often each occurs.

    For all that needs no words: those that share a bucket are counted together, within the row and without a shuffle.
    """

    @F.arrow_udf("struct<buckets:array<int>,tfs:array<int>>")
    def count(lists: pa.Array) -> pa.Array:
        return counted_lists(lists)

    counted = texts.withColumn("_counted", count.asNondeterministic()(hashed_words(F.col(text), language, n_features)))
    return counted.select(*texts.columns, F.col("_counted.buckets").alias("_buckets"), F.col("_counted.tfs").alias("_tfs"))


def counted_lists(lists: pa.ListArray) -> pa.StructArray:
    """The different buckets of every list, ``buckets``, with their counts, ``tfs``."""
    buckets, tfs, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], [np.zeros(0, int)]
    for part in parts_of(iter([pa.RecordBatch.from_arrays([lists], names=["buckets"])]), "buckets"):
        row, bucket, tf = bucket_counts(part.column("buckets"))
        buckets.append(bucket)
        tfs.append(tf)
        sizes.append(np.bincount(row, minlength=part.num_rows))
    ends = pa.array(np.r_[0, np.cumsum(np.concatenate(sizes))].astype(np.int32))
    found = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x), pa.int32())) for x in (buckets, tfs)]
    return pa.StructArray.from_arrays(found, ["buckets", "tfs"])


def document_weights(rows: DataFrame, n_features: int) -> np.ndarray:
    """Inverse document frequency of every bucket, 0 where no row has it; at most one row per bucket is collected."""
    spread = rows.select(F.explode(F.array_distinct("_buckets")).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("df"))
    n_rows, found = rows.count(), spread.toArrow()
    idf = np.zeros(n_features)
    idf[found.column("bucket").to_numpy()] = np.log((n_rows + 1) / (found.column("df").to_numpy() + 1)) + 1
    return idf


# --- inside tasks -------------------------------------------------------------------------------


def bucket_counts(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and count of the different buckets of every list, in this order."""
    row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    key, tf = np.unique((row << 32) + lists.flatten().to_numpy(zero_copy_only=False), return_counts=True)
    return key >> 32, key & 0xFFFFFFFF, tf


class _Rows:
    """Rows of one Arrow batch as coordinates: row, bucket and value of every entry.

    Without ``tfs``, buckets may repeat in a row, and entries are the different ones in order.
    """

    def __init__(self, buckets: pa.ListArray, tfs: pa.ListArray | None, idf: np.ndarray):
        self.n = len(buckets)
        if tfs is None:
            self.row, self.bucket, tf = bucket_counts(buckets)
            self.sizes = np.bincount(self.row, minlength=self.n)
        else:
            self.sizes = np.diff(buckets.offsets.to_numpy())
            self.row = np.repeat(np.arange(self.n), self.sizes)
            self.bucket, tf = (x.flatten().to_numpy(zero_copy_only=False) for x in (buckets, tfs))
        raw = tf * idf[self.bucket]
        key = self.row.astype(np.int64) * len(idf) + self.bucket
        if (np.diff(key) > 0).all():
            squares = np.bincount(self.row, raw * raw, self.n)
        else:  # words that share a bucket add up before the length is taken
            key, at = np.unique(key, return_inverse=True)
            merged = np.bincount(at, raw, len(key))
            squares = np.bincount(key // len(idf), merged * merged, self.n)
        self.value = raw * np.divide(ROW_LENGTH, np.sqrt(squares), out=np.zeros(self.n), where=squares > 0)[self.row]

    def margins(self, weights: np.ndarray) -> np.ndarray:
        out = np.empty((self.n, weights.shape[1]))
        for head in range(weights.shape[1]):
            own = weights[:, head]
            out[:, head] = np.bincount(self.row, self.value * own[self.bucket], self.n) + own[-1]
        return out

    def add_products(self, out: np.ndarray, factors: np.ndarray) -> None:
        """Add to ``out[bucket, head]`` the values times the rows' factors; intercepts get the factors themselves."""
        n_features = len(out) - 1
        for head in range(factors.shape[1]):
            out[:-1, head] += np.bincount(self.bucket, self.value * factors[self.row, head], n_features)
            out[-1, head] += factors[:, head].sum()


def _chance(margins: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margins, -700, 700)))


def parts_of(batches: Iterator[pa.RecordBatch], column: str, entries: int = ENTRIES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that ``column``, a list, holds about ``entries`` entries in each; single rows stay whole."""
    for batch in batches:
        ends = batch.column(column).offsets.to_numpy()
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(ends, ends[start] + entries, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


# --- passes -------------------------------------------------------------------------------------


def summed(rows: DataFrame, shape: tuple[int, int], task: Callable[[Iterator[pa.RecordBatch], np.ndarray], None]) -> np.ndarray:
    """Sum over all rows of what ``task(batches, out)`` adds to a matrix of ``shape``, in one job.

    Partial matrices are cut into slices of rows and added up by as many tasks as there are
    slices. The result must fit ``MODEL_BYTES``.
    """
    if shape[0] * shape[1] * 8 > MODEL_BYTES:
        raise ValueError(f"a matrix of {shape[0]} x {shape[1]} exceeds MODEL_BYTES")

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(shape)
        task(batches, out)
        for n, start in enumerate(range(0, shape[0], SLICE)):
            block = out[start : start + SLICE]
            if block.any():
                yield pa.RecordBatch.from_pydict({"slice": pa.array([n], pa.int32()), "block": [block.tobytes()]})

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for n, block in zip(batch.column("slice").to_pylist(), batch.column("block")):
                part = np.frombuffer(block.as_buffer(), np.float64)
                sums[n] = sums[n] + part if n in sums else part.copy()
        for n, block in sums.items():
            yield pa.RecordBatch.from_pydict({"slice": pa.array([n], pa.int32()), "block": [block.tobytes()]})

    parts = rows.mapInArrow(partial, _SLICES)
    total = np.zeros(shape)
    for row in parts.repartition("slice").mapInArrow(added, _SLICES).toArrow().to_pylist():
        start = row["slice"] * SLICE
        total[start : start + SLICE] = np.frombuffer(row["block"], np.float64).reshape(-1, shape[1])
    return total


def class_balance(rows: DataFrame, n_tasks: int) -> np.ndarray:
    """``(tasks, 2)`` weights n / (2 n_c) of negative and positive rows; 0 for tasks that lack one class."""
    sums = [F.count_if(F.col("targets")[t] == c).alias(f"n{t}_{c}") for t in range(n_tasks) for c in (0, 1)]
    n = np.array(rows.agg(*sums).first(), float).reshape(n_tasks, 2)
    total = n.sum(axis=1, keepdims=True)
    return np.where((n > 0).all(axis=1, keepdims=True), total / (2 * np.maximum(n, 1)), 0.0)


def losses_and_gradients(
    rows: DataFrame, model: LinearModel, tasks: list[int], balance: np.ndarray, gradients: bool = True
) -> tuple[np.ndarray, np.ndarray | None]:
    """Weighted mean log loss of every head and its gradient, in one pass; head ``i`` predicts ``targets[tasks[i]]``.

    Rows whose target is null do not count for that head.
    """
    context = rows.sparkSession.sparkContext
    shared = context.broadcast((model.idf, model.weights))
    heads, n_features = len(tasks), model.n_features
    # one more matrix row each for the losses and the weights they are means over
    shape = (n_features + 1 if gradients else 0) + 2

    def run(batches: Iterator[pa.RecordBatch], out: np.ndarray) -> None:
        idf, weights = shared.value
        for batch in parts_of(batches, "_buckets"):
            entries = _Rows(batch.column("_buckets"), batch.column("_tfs"), idf)
            target = np.array([[np.nan if t is None else t for t in row] for row in batch.column("targets").to_pylist()], float)
            target = target.reshape(batch.num_rows, -1)[:, tasks]
            known = ~np.isnan(target)
            importance = np.where(target == 1, balance[tasks, 1], balance[tasks, 0]) * known
            target = np.where(known, target, 0.0)
            margins = entries.margins(weights)
            loss = np.logaddexp(0, margins) - target * margins
            out[-2] += (loss * importance).sum(axis=0)
            out[-1] += importance.sum(axis=0)
            if gradients:
                entries.add_products(out[:-2], importance * (_chance(margins) - target))

    sums = summed(rows.select("_buckets", "_tfs", "targets"), (shape, heads), run)
    shared.unpersist()
    total = np.where(sums[-1] > 0, sums[-1], 1.0)
    return sums[-2] / total, sums[:-2] / total if gradients else None


class _QuasiNewton:
    """Limited-memory steps for independent columns of a matrix."""

    def __init__(self, shape: tuple[int, int]):
        self.moves = np.zeros((HISTORY, *shape))
        self.changes = np.zeros((HISTORY, *shape))
        self.curvature = np.zeros((HISTORY, shape[1]))  # 0: no entry

    def remember(self, columns: np.ndarray, move: np.ndarray, change: np.ndarray) -> None:
        product = (move * change).sum(axis=0)
        columns = columns & (product > 1e-12)
        for kept, new in ((self.moves, move), (self.changes, change), (self.curvature, product)):
            kept[:-1] = np.where(columns, kept[1:], kept[:-1])
            kept[-1] = np.where(columns, new, kept[-1])

    def direction(self, gradient: np.ndarray) -> np.ndarray:
        q, alphas = gradient.copy(), []
        used = self.curvature > 0
        inverse = np.divide(1.0, self.curvature, out=np.zeros_like(self.curvature), where=used)
        for i in reversed(range(HISTORY)):
            alpha = (self.moves[i] * q).sum(axis=0) * inverse[i]
            q -= alpha * self.changes[i]
            alphas.append(alpha)
        squares = (self.changes[-1] ** 2).sum(axis=0)
        q *= np.divide(self.curvature[-1], squares, out=np.ones_like(squares), where=squares > 0)
        for i, alpha in zip(range(HISTORY), reversed(alphas)):
            beta = (self.changes[i] * q).sum(axis=0) * inverse[i]
            q += (alpha - beta) * self.moves[i]
        return -q


def prepared(rows: DataFrame, name: str) -> DataFrame:
    """Feature rows as every pass reads them, written once to the checkpoint folder."""
    return written(rows.select("_buckets", "_tfs", "targets"), name)


def fit(
    rows: DataFrame, tasks: list[int], penalties: list[float], idf: np.ndarray, balance: np.ndarray, language: str,
    max_passes: int = 20, tolerance: float = 1e-4,
) -> Fit:
    """Fit heads to ``rows(_buckets, _tfs, targets)``, head ``i`` with ``penalties[i]`` on ``targets[tasks[i]]``.

    Stops after ``max_passes``, or once all gradients are shorter than ``tolerance``. Heads do not
    influence each other: each ends where it would end alone. A task without rows of both classes keeps zero weights.
    """
    penalty = np.array(penalties)
    weights = np.zeros((len(idf) + 1, len(tasks)))
    if weights.nbytes > MODEL_BYTES:
        raise ValueError(f"{len(tasks)} heads of {len(idf)} features exceed MODEL_BYTES")

    def evaluated(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        loss, gradient = losses_and_gradients(rows, LinearModel(idf, at, language), tasks, balance)
        gradient[:-1] += penalty * at[:-1]  # intercepts are not penalised
        return loss + penalty / 2 * (at[:-1] ** 2).sum(axis=0), gradient

    loss, gradient = evaluated(weights)
    memory, passes = _QuasiNewton(weights.shape), 1
    direction, step = -gradient, np.ones(len(tasks))
    while passes < max_passes and np.sqrt((gradient**2).sum(axis=0)).max(initial=0) > tolerance:
        tried = weights + step * direction
        new_loss, new_gradient = evaluated(tried)
        passes += 1
        slope = (gradient * direction).sum(axis=0)
        better = new_loss <= loss + 1e-4 * step * slope
        memory.remember(better, tried - weights, new_gradient - gradient)
        weights = np.where(better, tried, weights)
        gradient = np.where(better, new_gradient, gradient)
        loss = np.where(better, new_loss, loss)
        fresh = memory.direction(gradient)
        direction = np.where(better, fresh, direction)
        step = np.where(better, 1.0, step / 2)
    return Fit(LinearModel(idf, weights, language), loss, passes)


# --- scoring ------------------------------------------------------------------------------------


def margins(model: LinearModel, spark: SparkSession, words: Column) -> Column:
    """Margin of every head, for a column of counted words (``with_features``)."""
    return margins_of_counts(model, spark, buckets(words, model.n_features), counts(words))


def margins_of_counts(model: LinearModel, spark: SparkSession, hashed: Column, tfs: Column | None = None) -> Column:
    """Margin of every head, for buckets and their counts, or for all buckets of a text (``hashed_words``).

    The model, of at most ``MODEL_BYTES``, is broadcast. The function counts as nondeterministic: a filter on what is
    made of its result would else be moved below the words, which Spark then cuts once for every mention.
    """
    shared = spark.sparkContext.broadcast((model.idf, model.weights))

    def scored(batch: pa.RecordBatch) -> pa.Array:
        idf, weights = shared.value
        counted = "tfs" in batch.schema.names
        found = [
            _Rows(part.column("buckets"), part.column("tfs") if counted else None, idf).margins(weights)
            for part in parts_of(iter([batch]), "buckets")
        ]
        flat = np.concatenate(found) if found else np.zeros((0, weights.shape[1]))
        offsets = np.arange(0, flat.size + 1, weights.shape[1], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.ravel()))

    @F.arrow_udf("array<double>")
    def score(buckets: pa.Array) -> pa.Array:
        return scored(pa.RecordBatch.from_arrays([buckets], names=["buckets"]))

    @F.arrow_udf("array<double>")
    def score_counts(buckets: pa.Array, tfs: pa.Array) -> pa.Array:
        return scored(pa.RecordBatch.from_arrays([buckets, tfs], names=["buckets", "tfs"]))

    return score.asNondeterministic()(hashed) if tfs is None else score_counts.asNondeterministic()(hashed, tfs)


def contributions(model: LinearModel, spark: SparkSession, words: Column, head: int = 0) -> Column:
    """What each of the counted words adds to the margin of one head; with the intercept they add up to it."""
    shared = spark.sparkContext.broadcast((model.idf, np.ascontiguousarray(model.weights[:, head])))

    @F.arrow_udf("array<double>")
    def parts(buckets: pa.Array, tfs: pa.Array) -> pa.Array:
        idf, weights = shared.value
        batch = pa.RecordBatch.from_arrays([buckets, tfs], names=["buckets", "tfs"])
        values, sizes = [np.zeros(0)], [np.zeros(0, int)]
        for part in parts_of(iter([batch]), "buckets"):
            rows = _Rows(part.column("buckets"), part.column("tfs"), idf)
            values.append(rows.value * weights[rows.bucket])
            sizes.append(rows.sizes)
        offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values)))

    return parts.asNondeterministic()(buckets(words, model.n_features), counts(words))


def chance(margin: Column) -> Column:
    return 1 / (1 + F.exp(-margin))


# --- storing ------------------------------------------------------------------------------------


def save(model: LinearModel, spark: SparkSession, path: str) -> None:
    """Store a model as one row per bucket that any training row had, and one for the intercepts (bucket -1)."""
    used = np.flatnonzero((model.idf != 0) | (model.weights[:-1] != 0).any(axis=1))
    table = pa.table({
        "bucket": pa.array(np.r_[-1, used]),
        "idf": pa.array(np.r_[0.0, model.idf[used]]),
        "weights": pa.array([model.weights[-1].tolist(), *model.weights[used].tolist()], pa.list_(pa.float64())),
    })
    rows = spark.createDataFrame(table).selectExpr(
        "*", f"{model.n_features} AS n_features", f"{model.weights.shape[1]} AS heads", f"'{model.language}' AS language"
    )
    rows.write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> LinearModel:
    """A model stored by ``save``."""
    table = spark.read.parquet(path).toArrow()
    first = table.slice(0, 1).to_pylist()[0]
    idf, weights = np.zeros(first["n_features"]), np.zeros((first["n_features"] + 1, first["heads"]))
    bucket = table.column("bucket").to_numpy()
    at = np.where(bucket < 0, first["n_features"], bucket)
    weights[at] = np.array(table.column("weights").to_pylist(), float).reshape(len(at), first["heads"])
    kept = bucket >= 0
    idf[bucket[kept]] = table.column("idf").to_numpy()[kept]
    return LinearModel(idf, weights, first["language"])
