"""On-topic text detection: a binary classifier trained, applied and evaluated on Spark."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newscov.operators import linear
from newscov.operators.coverage import drop_empty_text
from newscov.operators.evaluate import accuracy_logloss, class_report, confusion
from newscov.operators.topics import salient_of_lists, top_words, with_word_counts
from newscov.scale import written
from newscov.schemas import require_columns

CANDIDATE_PENALTIES = (0.01, 0.1)
# Passes over the training texts, whatever the number of candidates.
MAX_ITER = 10

DETECTOR_RECORD = "losses MAP<DOUBLE, DOUBLE>, weights MAP<DOUBLE, DOUBLE>"


@dataclass
class Detector:
    """A fitted model with the validation loss of every candidate and the class weights of its training."""

    model: linear.LinearModel
    losses: dict[float, float]
    weights: dict[float, float]

    @property
    def language(self) -> str:
        return self.model.language


def _weight_of(label: str, weights: dict[float, float]) -> Column:
    """Weight of a row's class; there is one entry per class."""
    return F.create_map(*[F.lit(v) for pair in weights.items() for v in pair])[F.col(label).cast("double")]


def fit_detector(
    train: DataFrame,
    val: DataFrame,
    text: str = "text",
    label: str = "label",
    language: str = "french",
    penalties=CANDIDATE_PENALTIES,
    n_features: int = 1 << 18,
    max_iter: int = MAX_ITER,
) -> Detector:
    """Fit a class-weighted classifier per penalty and keep the one with the lowest validation loss.

    All candidates share every pass over the training texts, and one more over the validation
    texts compares them. Texts are cut into words once; what the passes read are hashed counts, held in the checkpoint folder.
    """

    def features(texts: DataFrame) -> DataFrame:
        kept = drop_empty_text(require_columns(texts, text, label).select(text, label), text).where(F.col(label).isNotNull())
        targets = F.array(F.col(label).cast("int")).alias("targets")
        return linear.with_bucket_counts(kept.select(text, targets), text, language, n_features)

    fitting, checking = linear.prepared(features(train), "detector-train"), linear.prepared(features(val), "detector-val")
    idf = linear.document_weights(fitting, n_features)
    balance = linear.class_balance(fitting, 1)
    if not balance.any():
        raise ValueError("training texts need both classes")
    tasks = [0] * len(penalties)
    fit = linear.fit(fitting, tasks, list(penalties), idf, balance, language, max_iter)
    checked, _ = linear.losses_and_gradients(checking, fit.model, tasks, balance, gradients=False)
    best = int(np.argmin(checked))
    losses = {float(p): float(loss) for p, loss in zip(penalties, checked)}
    return Detector(fit.model.only([best]), losses, {0.0: float(balance[0, 0]), 1.0: float(balance[0, 1])})


def save_detector(detector: Detector, spark: SparkSession, path: str) -> None:
    """Store a detector, so that scoring can be a job of its own."""
    linear.save(detector.model, spark, f"{path}/model")
    record = spark.createDataFrame([(detector.losses, detector.weights)], DETECTOR_RECORD)
    record.coalesce(1).write.mode("overwrite").parquet(f"{path}/record")


def load_detector(spark: SparkSession, path: str) -> Detector:
    """A detector stored by ``save_detector``."""
    record = spark.read.parquet(f"{path}/record").first()
    return Detector(linear.load(spark, f"{path}/model"), record["losses"], record["weights"])


def _decided(margin: Column) -> tuple[Column, Column]:
    """The class a margin decides for and how sure it is."""
    likely = linear.chance(margin)
    return (margin > 0).cast("int").alias("climate_related"), F.greatest(likely, 1 - likely).alias("confidence")


def predict(detector: Detector, texts: DataFrame, text: str = "text", row_id: str | None = None) -> DataFrame:
    """Add ``climate_related`` and ``confidence``, and with ``row_id`` the three salient ``top_words``.

    With ``row_id`` the text itself is left out, so that no text is moved to meet its words;
    who needs it joins it by ``row_id``. Texts are cut into words once, for scores and salient words.
    """
    texts = drop_empty_text(texts, text)
    if row_id is not None:
        lists = written(with_word_counts(texts, "_words", text, detector.language).drop(text), "word-lists")
        margin = linear.margins(detector.model, texts.sparkSession, F.col("_words"))[0]
        kept = [c for c in texts.columns if c != text]
        scored = lists.withColumn("_margin", margin).select(*kept, *_decided(F.col("_margin")))
        found = top_words(salient_of_lists(lists.select(row_id, F.col("_words").alias("words")), row_id), row_id)
        return scored.join(found, row_id, "left")
    hashed = linear.hashed_words(F.col(text), detector.language, detector.model.n_features)
    margin = linear.margins_of_counts(detector.model, texts.sparkSession, hashed)[0]
    return texts.withColumn("_margin", margin).select(*texts.columns, *_decided(F.col("_margin")))


def reasons(detector: Detector, texts: DataFrame, *keep: str, text: str = "text", top: int = 3) -> DataFrame:
    """The decision on every text with the words it rests on: ``keep``, ``climate_related``, ``confidence``, ``margin``,
    ``intercept``, ``top_words`` and ``contributions``.

    Every word adds its count times its weights to the margin; ``contributions`` lists all words with what
    they add, strongest support for the decision first, and together with the intercept they are the margin.
    ``top_words`` are the first that support it. All within the row: no text or word is shuffled.
    """
    texts = drop_empty_text(texts, text)
    counted = linear.with_features(texts.select(*keep, text), text, detector.language, detector.model.n_features)
    shares = linear.contributions(detector.model, texts.sparkSession, F.col("_words"))
    counted = counted.select(*keep, F.coalesce("_words", F.array().cast("array<struct<word:string,tf:int>>")).alias("_words"), shares.alias("_shares"))
    intercept = float(detector.model.weights[-1, 0])
    total = F.aggregate("_shares", F.lit(intercept), lambda a, x: a + x)
    counted = counted.withColumn("margin", total)
    # a text with no margin counts as off topic, like one below it
    sign = F.when(F.col("margin") > 0, 1.0).otherwise(-1.0)
    ranked = F.array_sort(F.zip_with(
        "_words", "_shares", lambda w, x: F.struct((-x * sign).alias("against"), w["word"].alias("word"))
    ))
    counted = counted.withColumn("_ranked", ranked)
    supports = F.filter("_ranked", lambda r: r["against"] < 0)
    return counted.select(
        *keep, *_decided(F.col("margin")), "margin", F.lit(intercept).alias("intercept"),
        F.transform(F.slice(supports, 1, top), lambda r: r["word"]).alias("top_words"),
        F.transform("_ranked", lambda r: F.struct(r["word"].alias("word"), (-r["against"] * sign).alias("share"))).alias("contributions"),
    )


def evaluate(
    scored: DataFrame, label: str = "label", weights: dict[float, float] | None = None
) -> dict[str, DataFrame]:
    """Confusion matrix, per-class report and accuracy with log loss, weighted as in training if ``weights`` are given.

    Texts are scored once for all three: labels and decisions are held in the checkpoint folder.
    """
    scored = written(scored.select(label, "climate_related", "confidence"), "scored")
    weight = None if weights is None else _weight_of(label, weights)
    return {
        "confusion": confusion(scored, label, "climate_related"),
        "report": class_report(scored, label, "climate_related"),
        "loss": accuracy_logloss(scored, label, "climate_related", weight=weight),
    }
