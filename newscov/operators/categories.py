"""Sub-categories of on-topic texts: a multi-label classifier, trained, applied and stored on Spark."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newscov.functions.labels import coded_labels, present_labels
from newscov.operators import linear
from newscov.operators.coverage import drop_empty_text
from newscov.schemas import ANNOTATION_COLUMNS, PREDICTION_COLUMNS, require_columns
from newscov.taxonomy import MACRO_CODES, METRIC_CODES

PENALTIES = (0.01, 0.1)
MAX_PASSES = 15
N_FEATURES = 1 << 16
#: Steps of the probabilities that thresholds are chosen from.
BINS = 100

CATEGORY_RECORD = "codes ARRAY<STRING>, penalties ARRAY<DOUBLE>, thresholds ARRAY<DOUBLE>"


@dataclass
class CategoryModel:
    """One classifier per code with its own penalty and threshold; null threshold: nothing to learn the code from."""

    codes: tuple[str, ...]
    model: linear.LinearModel
    penalties: list[float]
    thresholds: list[float | None]


def _features(texts: DataFrame, text: str, labels: Column, codes, language: str, n_features: int) -> DataFrame:
    """Counted words and one 0/1 target per code of every annotated text."""
    rows = drop_empty_text(texts.select(text, labels.alias("_truth")), text).where(F.size("_truth") > 0)
    targets = F.array(*[F.array_contains("_truth", code).cast("int") for code in codes])
    return linear.with_bucket_counts(rows.select(text, targets.alias("targets")), text, language, n_features)


def best_thresholds(scored: DataFrame, codes, bins: int = BINS) -> list[float | None]:
    """Per code the probability that parts rows with the highest F1 on ``scored(chances, targets)``.

    Rows are counted per code, bin and target in one aggregation; ``codes * bins`` counts come back. Of equally good
    thresholds the highest counts. A code that no row has gets none.
    """
    binned = F.transform(
        F.arrays_zip("chances", "targets"),
        lambda x, i: F.struct(
            i.alias("code"), F.least(F.floor(x["chances"] * bins), F.lit(bins - 1)).cast("int").alias("bin"), x["targets"].alias("target")
        ),
    )
    counted = scored.select(F.inline(binned)).groupBy("code", "bin").agg(
        F.count("*").alias("rows"), F.sum("target").alias("hits")
    )
    rows, hits = np.zeros((len(codes), bins)), np.zeros((len(codes), bins))
    for r in counted.collect():
        rows[r["code"], r["bin"]], hits[r["code"], r["bin"]] = r["rows"], r["hits"]
    found: list[float | None] = []
    for of_code, hit in zip(rows, hits):
        predicted, right = np.cumsum(of_code[::-1])[::-1], np.cumsum(hit[::-1])[::-1]  # at or above each bin
        f1 = 2 * right / np.maximum(predicted + hit.sum(), 1)
        best = np.flatnonzero(f1 == f1.max())[-1]
        found.append(float(best / bins) if hit.sum() else None)
    return found


def fit_categories(
    train: DataFrame, val: DataFrame, text: str = "text", labels=ANNOTATION_COLUMNS, macro: bool = False, language: str = "french",
    penalties=PENALTIES, n_features: int = N_FEATURES, max_passes: int = MAX_PASSES,
) -> CategoryModel:
    """Learn every code from annotated texts, all codes and penalties in the same passes.

    ``labels`` are the annotation columns: names or codes for the micro set, codes for the macro set. Rows without
    a known label teach nothing. On the validation part each code takes the penalty with the lowest loss and the
    threshold with the highest F1. Codes without positive and negative training rows are never predicted.
    """
    codes = tuple(MACRO_CODES if macro else METRIC_CODES)
    truth = (present_labels if macro else coded_labels)(*labels)

    def ready(texts: DataFrame, name: str) -> DataFrame:
        return linear.prepared(_features(require_columns(texts, text, *labels), text, truth, codes, language, n_features), name)

    fitting, checking = ready(train, "categories-train"), ready(val, "categories-val")
    idf = linear.document_weights(fitting, n_features)
    balance = linear.class_balance(fitting, len(codes))
    known = [c for c in range(len(codes)) if balance[c].any()]
    if not known:
        raise ValueError("no code has both positive and negative training texts")
    heads = [(c, p) for c in known for p in penalties]
    tasks, each = [c for c, _ in heads], [p for _, p in heads]
    # weights that favour rare codes would make every text name many of them: plain means here
    plain = np.where(balance > 0, 1.0, 0.0)
    fit = linear.fit(fitting, tasks, each, idf, plain, language, max_passes)
    losses, _ = linear.losses_and_gradients(checking, fit.model, tasks, plain, gradients=False)
    chosen = {c: min((h for h in range(len(heads)) if tasks[h] == c), key=lambda h: losses[h]) for c in known}
    kept = fit.model.only([chosen[c] for c in known])
    scored = checking.select(
        _chances_of(linear.margins_of_counts(kept, checking.sparkSession, F.col("_buckets"), F.col("_tfs"))).alias("chances"),
        F.array(*[F.col("targets")[c] for c in known]).alias("targets"),
    )
    found = dict(zip(known, best_thresholds(scored, known)))
    weights = np.zeros((n_features + 1, len(codes)))
    weights[:, known] = kept.weights
    return CategoryModel(
        codes, linear.LinearModel(idf, weights, language), [each[chosen[c]] if c in chosen else None for c in range(len(codes))],
        [found.get(c) for c in range(len(codes))],
    )


def _chances_of(margins: Column) -> Column:
    return F.transform(margins, linear.chance)


def predict_categories(model: CategoryModel, texts: DataFrame, text: str = "text", top: int = 3) -> DataFrame:
    """Add ``prediction_label_1`` to ``_3``: the codes that reach their threshold, the most probable first.

    The most probable code is always named, as every text put to the classifier is on topic; a null or empty text gets none.
    Ties go by the codes' order. Nothing is shuffled.
    """
    counted = texts.withColumn("_hashed", linear.hashed_words(F.col(text), model.model.language, model.model.n_features))
    margins = linear.margins_of_counts(model.model, texts.sparkSession, F.col("_hashed"))
    counted = counted.withColumn("_margins", margins)
    usable = [c for c in range(len(model.codes)) if model.thresholds[c] is not None]
    entries = F.array(*[
        F.struct(
            (-F.col("_margins")[c]).alias("minus"), F.lit(n).alias("n"), F.lit(model.codes[c]).alias("code"),
            (linear.chance(F.col("_margins")[c]) >= model.thresholds[c]).alias("reached"),
        )
        for n, c in enumerate(usable)
    ])
    counted = counted.withColumn("_ranked", F.array_sort(entries))
    first = F.slice("_ranked", 1, 1)
    others = F.filter(F.slice("_ranked", 2, len(usable)), lambda e: e["reached"])
    named = F.when(F.size("_hashed") > 0, F.transform(F.concat(first, others), lambda e: e["code"]))
    counted = counted.withColumn("_named", named)
    out = [F.when(F.lit(i <= top), F.try_element_at("_named", F.lit(i))).alias(c) for i, c in enumerate(PREDICTION_COLUMNS, 1)]
    return counted.select(*[F.col(c) for c in texts.columns], *out)


def save_categories(model: CategoryModel, spark: SparkSession, path: str) -> None:
    """Store a model, so that scoring can be a job of its own."""
    linear.save(model.model, spark, f"{path}/model")
    record = spark.createDataFrame([(list(model.codes), model.penalties, model.thresholds)], CATEGORY_RECORD)
    record.coalesce(1).write.mode("overwrite").parquet(f"{path}/record")


def load_categories(spark: SparkSession, path: str) -> CategoryModel:
    """A model stored by ``save_categories``."""
    record = spark.read.parquet(f"{path}/record").first()
    return CategoryModel(tuple(record["codes"]), linear.load(spark, f"{path}/model"), record["penalties"], record["thresholds"])
