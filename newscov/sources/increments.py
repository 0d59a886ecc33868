"""Daily counts of a folder that grows: every load reads only files that no load before has counted.

A load counts its files by day and outlet and writes the counts under the name of its *batch*, a digest of
the files' names, sizes and times. Only then does it enter the files in the ledger, in one write; readers take the counts of
batches in the ledger alone. A load that is lost midway and repeated, with the same files or with more,
therefore counts nothing twice and loses nothing: what it left behind is overwritten or never read.

One load at a time may write to a folder. Files must not change once they are loaded; a load that finds one changed fails.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newscov.functions.dates import period_start

_LEDGER = "file STRING, length LONG, modified TIMESTAMP, batch STRING"


def _stored(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """Files counted so far, with the batch each came in."""
    found = _stored(spark, f"{path}/ledger", _LEDGER)
    return spark.createDataFrame([], _LEDGER) if found is None else found


def new_files(spark: SparkSession, source: str, path: str, pattern: str = "*") -> DataFrame:
    """Files below ``source`` that are not in the ledger; their contents are not read."""
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(source)
        .select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified"))
    )
    known = ledger(spark, path).select("file", F.col("length").alias("_length"), F.col("modified").alias("_modified"))
    met = listed.join(known, "file", "left")
    changed = met.where("_length IS NOT NULL AND (_length <> length OR _modified <> modified)").limit(1).collect()
    if changed:
        raise ValueError(f"{changed[0]['file']} has changed since it was counted")
    return met.where("_length IS NULL").drop("_length", "_modified")


def daily_counts(articles: DataFrame) -> DataFrame:
    """Articles and on-topic articles per day and outlet; articles without a date under a null day."""
    day = period_start(F.col("date"), "day")
    return articles.groupBy(day.alias("day"), "media").agg(
        F.count("*").alias("total_articles"), F.count_if(F.col("label") == 1).alias("articles_climat")
    )


def load(
    spark: SparkSession, source: str, path: str, read: Callable[[SparkSession, list[str]], DataFrame], pattern: str = "*"
) -> int:
    """Count the files below ``source`` that no load has counted yet, and return how many they were.

    ``read(spark, files)`` gives dated articles (``date``, ``media``, ``label``) of the named files. File names
    come to the driver, as they do whenever Spark reads files; articles do not.
    """
    fresh = new_files(spark, source, path, pattern)
    files = sorted(fresh.collect())
    if not files:
        return 0
    batch = hashlib.sha256("".join(f"{f}|{n}|{at}\n" for f, n, at in files).encode()).hexdigest()
    counts = daily_counts(read(spark, [f["file"] for f in files]))
    counts.write.mode("overwrite").parquet(f"{path}/counts/batch={batch}")
    entered = spark.createDataFrame(files, fresh.schema).withColumn("batch", F.lit(batch))
    entered.coalesce(1).write.mode("append").parquet(f"{path}/ledger")
    return len(files)


def stored_counts(spark: SparkSession, path: str) -> DataFrame:
    """Counts per day and outlet over all batches in the ledger."""
    found = _stored(spark, f"{path}/counts")
    if found is None:
        return spark.createDataFrame([], "day DATE, media STRING, total_articles LONG, articles_climat LONG")
    done = ledger(spark, path).select("batch").distinct()
    known = found.withColumn("batch", F.col("batch").cast("string")).join(done, "batch", "left_semi")
    return known.groupBy("day", "media").agg(
        F.sum("total_articles").alias("total_articles"), F.sum("articles_climat").alias("articles_climat")
    )


def coverage_of(counts: DataFrame, period: str = "month") -> DataFrame:
    """``coverage.coverage`` from stored counts."""
    summed = counts.where(F.col("day").isNotNull()).groupBy(period_start(F.col("day"), period).alias("period")).agg(
        F.sum("total_articles").alias("total_articles"), F.sum("articles_climat").alias("articles_climat")
    )
    return summed.withColumn("ratio", 100.0 * F.col("articles_climat") / F.col("total_articles"))


def outlet_share_of(counts: DataFrame) -> DataFrame:
    """Articles and percentage on topic per outlet from stored counts, articles without a date included."""
    summed = counts.groupBy("media").agg(
        F.sum("total_articles").alias("total_articles"), F.sum("articles_climat").alias("articles_climat")
    )
    return summed.withColumn("share", F.try_divide(100.0 * F.col("articles_climat"), F.col("total_articles")))
