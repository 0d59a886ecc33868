"""On-topic detection from raw texts to stored scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newscov.operators import detect, splits
from newscov.operators.evaluate import split_total
from newscov.sources.readers import read_any
from newscov.sources.sinks import run_id, write_result, write_run_parameters, write_splits


def train_detector(
    texts: DataFrame, row_id: str, folder: str | None = None, text: str = "text", label: str = "label", **options
) -> tuple[detect.Detector, dict[str, DataFrame]]:
    """Split, fit and evaluate on the test part; with ``folder`` also store splits, model, parameters and reports."""
    split = splits.stratified_split(detect.drop_empty_text(texts, text), row_id, label)
    train, val, test = (split.where(split["split"] == name) for name in splits.SPLITS)
    detector = detect.fit_detector(train, val, text, label, **options)
    if folder is not None:
        spark = texts.sparkSession
        weights = [detector.weights[c] for c in sorted(detector.weights)]
        total = split_total(splits.split_sizes(split, label)).first()["len_dataset"]
        write_splits(split, f"{folder}/splits")
        detect.save_detector(detector, spark, f"{folder}/detector")
        epochs = options.get("max_iter", detect.MAX_ITER)
        write_run_parameters(spark, f"{folder}/params", weights, total, epoch=epochs)
    reports = detect.evaluate(detect.predict(detector, test, text), label, detector.weights)
    if folder is not None:
        write_reports(reports, folder)
    return detector, reports


def write_reports(reports: dict[str, DataFrame], folder: str) -> None:
    """Store every evaluation table under its name."""
    for name, report in reports.items():
        write_result(report, f"{folder}/{name}")


def detect_file(
    spark: SparkSession, path: str, detector: detect.Detector, row_id: str, folder: str,
    text: str = "text", label: str | None = None, run: str | None = None,
) -> DataFrame:
    """Score the texts of a file and store the scores by ``row_id`` under a run id, with reports when labels are given."""
    target = f"{folder}/{run or run_id()}"
    write_result(detect.predict(detector, read_any(spark, path), text, row_id), f"{target}/inference")
    scored = spark.read.parquet(f"{target}/inference")
    if label is not None:
        write_reports(detect.evaluate(scored, label, detector.weights), target)
    return scored
