"""Helpers the operators share: tables in the shared folder, connected components, Arrow batches."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import newscov
from newscov.scale import use_checkpoint_dir

# Functions that run in tasks travel as code, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(newscov)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder that all executors reach."""
    use_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    It cuts the lineage as ``checkpoint`` does and survives lost executors, but takes
    less disk: columns are compressed, and later readers prune those they do not need.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, name)
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def working_columns(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names; all others cannot clash then."""
    return df.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``limit`` bytes in each; single rows stay whole."""
    for batch in batches:
        values = batch.column(column)
        sizes = [v or 0 for v in pa.compute.binary_length(values).to_pylist()]
        start = total = 0
        for i, size in enumerate(sizes):
            if total and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)


def give_back() -> None:
    """Hand freed memory back to the system; the allocators of Arrow and C else keep it for the process."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def freeing(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``task`` for mapInArrow, with its memory handed back at its end.

    Spark keeps the worker process for tasks to come, and while it idles or JVM stages run, its memory counts as well.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            give_back()

    return run


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` as stored, with a ``node`` number that no two rows share."""
    return stored(df.withColumn("node", F.monotonically_increasing_id()), name)


def with_components(classes: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """``(key, rep, copies, links, component)`` of all classes, from ``found(node, links, root)``.

    ``links`` adds up what is known of a node, ``component`` is the smallest ``rep`` of the
    classes that roots join; both are null for classes that nothing is known of.
    """
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), name)
    joined = joined.withColumnRenamed("component", "part")
    known = classes.select("node", "key", "rep", "copies").join(joined, "node", "left").join(linked, "node", "left")
    least = known.where("part IS NOT NULL").groupBy("part").agg(F.min("rep").alias("component"))
    return known.join(least, "part", "left").select("key", "rep", "copies", "links", "component")


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``: the smallest node it can reach.

    Large-star and small-star rounds (Kiveris et al. 2014): each node hooks its larger
    neighbours, then its smaller ones, to the smallest it knows, until every component is a
    star around its minimum. Minima are partial aggregates and the joins are plain equi-joins
    that adaptive execution splits, so a hub costs no single task more than others.
    """
    spark = edges.sparkSession
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    links = stored(links, name)
    before = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, name)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hooked = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = stored(hooked.unionByName(least.withColumnRenamed("m", "v")).where("u > v").distinct(), name)
        state = links.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")
        ).first()
        if state == before:
            break
        before = state
    roots = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.withColumn("component", F.col("node"))
    )
