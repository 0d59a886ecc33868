"""Helpers that keep ordering, windows and key lookups spread over many tasks."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows per window task in rolling_rows.
WINDOW_CHUNK = 200_000
# Rows that one task merges when the first rows of a table are wanted.
MOST_TOP = 100_000


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Point checkpoints at the folder the cluster names; make one only on local masters."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="newscov-checkpoint-")
    sc.setCheckpointDir(folder)


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder and read it back, so that lost executors cost nothing."""
    use_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the checkpoint folder and read it back.

    Like ``checkpointed``, but compressed and by columns: for what many jobs read again.
    """
    spark = df.sparkSession
    use_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def with_position(df: DataFrame, *order: str | Column, name: str = "position") -> DataFrame:
    """Add the 1-based global row number in ``order``, without a one-task window.

    ``order`` must identify rows uniquely. Rows are range-partitioned and sorted;
    the offset of each range comes from a table with one row per partition.
    The checkpoint pins the ranges, which a second evaluation could cut elsewhere.
    """
    bits = 33  # monotonically_increasing_id keeps the partition number above bit 33
    ranged = checkpointed(df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id()))
    ranged = ranged.withColumn("_range", F.shiftright("_slot", bits))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("_range")
        .agg(F.count("*").alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    offset = F.col("_slot").bitwiseAND(F.lit((1 << bits) - 1))
    return (
        ranged.join(F.broadcast(starts), "_range")
        .withColumn(name, F.col("_start") + offset + 1)
        .drop("_range", "_start", "_slot")
    )


def row_key(df: DataFrame, order: list[str]) -> Column:
    """Key of a row's place in ``order``, nulls first; ties go by a hash of the whole row, so that only equal rows share one."""
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("_tie")
    return F.struct(*[F.col(f"`{c}`") for c in order], tie)


def first_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """The first ``n`` rows in ``order``, nulls first. Each task passes on its ``n`` smallest keys; no rows are sorted.

    Beyond ``MOST_TOP`` rows all keys are ranked instead, as one task merges the smallest.
    """
    if n > MOST_TOP:
        return rows_between(df, order, lambda _: (1, n))
    if n < 1:
        return df.limit(0)
    key = row_key(df, order)
    # one key more tells whether copies of the last row stay outside
    top = df.select(key.alias("_key")).orderBy("_key").limit(n + 1).agg(F.sort_array(F.collect_list("_key")).alias("k")).first()["k"]
    if len(top) <= n:
        return df
    last = _literal(df, order, top[n - 1])
    if top[n] != top[n - 1]:
        return df.where(key <= last)
    copies = sum(k == top[n - 1] for k in top[:n])
    return df.where(key < last).unionByName(df.where(key == last).limit(copies))


def _constant(value, kind: T.DataType) -> Column:
    """A collected value as a constant of its column's type; a time without zone takes no detour over one."""
    if isinstance(kind, T.TimestampNTZType) and value is not None:
        value = value.isoformat(sep=" ")
    return F.lit(value).cast(kind)


def _literal(df: DataFrame, order: list[str], key) -> Column:
    """A collected ``row_key`` as a constant of the same type."""
    fields = [_constant(value, df.schema[c].dataType).alias(c) for c, value in zip(order, key)]
    return F.struct(*fields, F.lit(key[len(order)]).cast("long").alias("_tie"))


class PageIndex:
    """First and last key of every page of a table, stored once, so that a page costs one filtered scan.

    Built by one range sort of the keys. Entries are sorted by page number, so that looking one up reads one
    row group. Rows that equal a page's first or last row and lie on other pages are told apart by count. The index
    belongs to the rows it was built from: build it anew when they change.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.entries = spark.read.parquet(path)

    @staticmethod
    def build(rows: DataFrame, order: list[str], size: int, path: str) -> PageIndex:
        """Index ``rows`` in ``order``, nulls first, in pages of ``size`` rows."""
        spark = rows.sparkSession
        placed = with_position(rows.select(row_key(rows, order).alias("_key")), "_key")
        page = F.expr(f"(position - 1) div {size}") + 1
        pages = placed.groupBy(page.alias("page")).agg(
            F.min("_key").alias("low"), F.max("_key").alias("high"), F.count("*").alias("rows"), F.collect_list("_key").alias("_keys")
        )  # a list holds one page
        pages = pages.select(
            "page", "low", "high", "rows",
            F.size(F.filter("_keys", lambda k: k == F.col("low"))).alias("low_rows"),
            F.size(F.filter("_keys", lambda k: k == F.col("high"))).alias("high_rows"),
        )
        pages = written(pages, "pages")
        before = pages.select((F.col("page") + 1).alias("page"), F.col("high").alias("_before"))
        after = pages.select((F.col("page") - 1).alias("page"), F.col("low").alias("_after"))
        shared = F.coalesce(F.col("_before") == F.col("low"), F.lit(False)) | F.coalesce(F.col("_after") == F.col("high"), F.lit(False))
        joined = pages.join(before, "page", "left").join(after, "page", "left").withColumn("shared", shared)
        done = joined.drop("_before", "_after").repartitionByRange("page").sortWithinPartitions("page")
        done.write.mode("overwrite").parquet(path)
        return PageIndex(spark, path)

    def page(self, rows: DataFrame, order: list[str], number: int) -> DataFrame:
        """Page ``number`` (from 1) of the rows the index was built from, in ``order``; no rows past the last page."""
        entry = self.entries.where(F.col("page") == number).first()
        if entry is None:
            return rows.limit(0)
        key, low, high = row_key(rows, order), _literal(rows, order, entry["low"]), _literal(rows, order, entry["high"])
        # plain comparisons of the first column, which reach the scan, come before those of whole keys
        first = F.col(f"`{order[0]}`")
        kind, (least, most) = rows.schema[order[0]].dataType, (entry["low"][0], entry["high"][0])
        near = rows
        if least is not None:
            near = near.where(first.between(_constant(least, kind), _constant(most, kind)))
        elif most is not None:
            near = near.where(first.isNull() | (first <= _constant(most, kind)))
        if not entry["shared"]:
            return near.where((key >= low) & (key <= high)).orderBy(*order)
        if entry["low"] == entry["high"]:
            return near.where(key == low).limit(entry["rows"])
        ends = near.where(key == low).limit(entry["low_rows"]).unionByName(near.where(key == high).limit(entry["high_rows"]))
        return ends.unionByName(near.where((key > low) & (key < high))).orderBy(*order)

    def info(self) -> DataFrame:
        """Number of rows and of pages; no rows still make one page."""
        pages = F.greatest(F.count("*"), F.lit(1)).alias("total_pages")
        return self.entries.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"), pages)


def rows_between(df: DataFrame, order: list[str], places: Callable[[int], tuple[int, int]]) -> DataFrame:
    """Rows from the first to the last place that ``places`` names for the number of rows.

    Places count from 1 in ``order``, nulls first; ties go by a hash of the whole row, so that
    only equal rows can stand for each other. Keys alone are ranked, and the rows are cut by
    comparing their own key with the keys at both ends. A struct compares its null fields
    first and always has an answer, so rows with null keys have a place like any other.
    """
    key = row_key(df, order)
    placed = checkpointed(with_position(df.select(key.alias("_key")), "_key"))
    n = placed.count()
    first, last = places(n)
    first, last = max(first, 1), min(last, n)
    if first > last:
        return df.limit(0)
    inside = placed.where(F.col("position").between(first, last))
    ends = inside.agg(F.struct(F.min("_key").alias("low"), F.max("_key").alias("high")).alias("ends")).scalar()

    def copies(end: str) -> DataFrame:
        """Rows at one end of the cut: all, or as many of the equal ones as lie inside."""
        at = df.where(key == ends[end])
        wanted = inside.where(F.col("_key") == ends[end]).count()
        return at if wanted == placed.where(F.col("_key") == ends[end]).count() else at.limit(wanted)

    low = copies("low")
    if not inside.where(F.col("_key") > ends["low"]).take(1):
        return low
    middle = df.where((key > ends["low"]) & (key < ends["high"]))
    return low.unionByName(middle).unionByName(copies("high"))


def rolling_rows(
    df: DataFrame,
    order: list[str],
    size: int,
    aggregates: dict[str, Column],
    within: list[str] | None = None,
    chunk: int | None = None,
) -> DataFrame:
    """Aggregate over the last ``size`` rows in ``order``, spread over tasks of ``chunk`` rows.

    Each chunk also receives the ``size - 1`` rows before it, so windows that
    reach back over a chunk border are whole. ``within`` restarts the window per key;
    ``order`` must then begin with those keys.
    """
    chunk = max(chunk or WINDOW_CHUNK, size)
    placed = with_position(df, *order, name="_pos").withColumn("_pos", F.col("_pos") - 1)
    home = F.expr(f"_pos div {chunk}")
    is_tail = F.pmod("_pos", F.lit(chunk)) >= chunk - (size - 1)
    copies = F.when(is_tail, F.array(home, home + 1)).otherwise(F.array(home))
    spread = placed.withColumn("_home", home).withColumn("_chunk", F.explode(copies))
    window = (
        Window.partitionBy("_chunk", *(within or []))
        .orderBy("_pos")
        .rowsBetween(-(size - 1), Window.currentRow)
    )
    for name, aggregate in aggregates.items():
        spread = spread.withColumn(name, aggregate.over(window))
    return spread.where(F.col("_home") == F.col("_chunk")).drop("_home", "_chunk", "_pos")


def key_totals(df: DataFrame, key: str, aggregates: dict[str, Column]) -> DataFrame:
    """Pre-aggregated values per non-null key, with the rows behind each, held in the checkpoint folder."""
    kept = df.where(F.col(key).isNotNull()).groupBy(key)
    return checkpointed(kept.agg(F.count("*").alias("_rows"), *[a.alias(n) for n, a in aggregates.items()]))


def attach_totals(df: DataFrame, key: str, totals: DataFrame) -> DataFrame:
    """Left-join ``key_totals`` to every row of ``df``; rows with a null key get nulls.

    Spark picks the join, and adaptive execution splits the rows of a frequent key.
    """
    return df.join(totals.drop("_rows"), key, "left")


def spread_scan(scan: DataFrame, key: str) -> DataFrame:
    """Hash the rows of a plain scan over all cores when it comes in fewer pieces than there are cores.

    For work that is heavy per row, such as cutting texts into words, on files with few
    row groups. Large inputs already have more pieces and pass unchanged, unshuffled.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores, key) if scan.rdd.getNumPartitions() < cores else scan


def small_side(df: DataFrame, max_rows: int) -> DataFrame:
    """Mark ``df`` for broadcast if it has at most ``max_rows`` rows, else leave the choice to Spark."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
