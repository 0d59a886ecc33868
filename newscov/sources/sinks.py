"""Writers for predictions, metrics, splits and run records."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newscov.functions.dates import period_start
from newscov.schemas import RUN_PARAMETERS, STORED_MONTH


def run_id(at: datetime | None = None) -> str:
    """Name of a run's output folder: its start time."""
    return (at or datetime.now()).strftime("%Y_%m_%d_%H_%M_%S")


def run_id_column(at: Column | None = None) -> Column:
    """Run id as an expression."""
    return F.date_format(F.current_timestamp() if at is None else at, "yyyy_MM_dd_HH_mm_ss")


def run_file_name(model: str, prompt_method: str, n_shots: int, recursive: bool = False) -> str:
    """Output name that tells how predictions were made."""
    return f"{model}_{prompt_method}_{n_shots}shots" + ("_recursive" if recursive else "")


def write_result(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """Replace the table at ``path``; ``csv`` has a header, quotes like the readers expect and lists as JSON."""
    if kind == "csv":
        nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
        df = df.withColumns({name: F.to_json(name) for name in nested})
    writer = df.write.mode("overwrite")
    if kind == "csv":
        writer = writer.option("header", True).option("quote", '"').option("escape", '"')
    writer.format(kind).save(path)


def store_articles(articles: DataFrame, path: str) -> None:
    """Store dated articles as Parquet by month, so that month filters read only their files.

    The rebalance hint lets Spark split a month that holds most rows and merge small ones.
    """
    months = articles.withColumn(STORED_MONTH, period_start(F.col("date"), "month"))
    months.hint("rebalance", STORED_MONTH).write.mode("overwrite").partitionBy(STORED_MONTH).parquet(path)


def _replace_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Write the partitions ``df`` has, each in place of what was there; others stay as they are."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_runs(predictions: DataFrame, path: str) -> None:
    """Store predictions by model, prompt method, examples and refinement.

    Combinations that ``predictions`` has are replaced, so a repeated job leaves one copy; other runs are untouched.
    """
    _replace_partitions(predictions, path, "model", "prompt_method", "n_shots", "recursive")


def append_metrics(metrics: DataFrame, path: str, run: str | None = None) -> None:
    """Add metric rows to a growing table.

    With the name of a run rows are stored under it, in a column ``run``, and a job that is repeated
    replaces what it wrote before. Without one every call adds its rows. A table takes either kind, not both.
    """
    if run is None:
        metrics.coalesce(1).write.mode("append").parquet(path)
    else:
        _replace_partitions(metrics.withColumn("run", F.lit(run)).coalesce(1), path, "run")


def write_splits(split: DataFrame, path: str) -> None:
    """Store the train, val and test rows in one folder each."""
    split.write.mode("overwrite").partitionBy("split").parquet(path)


def write_run_parameters(
    spark: SparkSession, path: str, weights: list[float], len_dataset: int, lr: float | None = None,
    batch_size: int | None = None, epoch: int | None = None, max_len: int | None = None,
) -> None:
    """Store the parameters of a training run as one JSON row; those a model does not have are left out."""
    row = (lr, batch_size, epoch, max_len, weights, len_dataset)
    spark.createDataFrame([row], RUN_PARAMETERS).coalesce(1).write.mode("overwrite").json(path)
