"""Leading, trailing and stratified parts of a table.

Only keys are ranked. The rows themselves are then cut by comparing their own key
with the key at the border, so wide rows are never sorted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newscov.scale import checkpointed, first_rows, rows_between, small_side, with_position

SPLITS = ("train", "val", "test")
MAX_BROADCAST_CLASSES = 10_000


def head_rows(df: DataFrame, order: list[str], n: int) -> DataFrame:
    """First ``n`` rows in ``order``, nulls first."""
    return first_rows(df, order, n)


def head_share(df: DataFrame, order: list[str], share: float = 0.8) -> DataFrame:
    """The leading ``int(share * n)`` rows in ``order``, nulls first."""
    return rows_between(df, order, lambda n: (1, int(share * n)))


def tail_share(df: DataFrame, order: list[str], share: float = 0.2) -> DataFrame:
    """The trailing ``int(share * n)`` rows in ``order``, nulls first."""
    return rows_between(df, order, lambda n: (n - int(share * n) + 1, n))


def stratified_split(
    df: DataFrame, row_id: str, label: str = "label", test_size: float = 0.3, seed: int = 42
) -> DataFrame:
    """Add ``split``: per class 1 - test_size for training, the rest halved into val and test.

    Rows are ranked within their class by a seeded hash of ``row_id``, which makes the
    split exact and repeatable.
    """
    draw = F.xxhash64(F.lit(seed), row_id)
    keys = df.select(F.col(label).alias("_label"), draw.alias("_draw"), F.col(row_id).alias("_id"))
    placed = with_position(keys, "_label", "_draw", "_id")
    sizes = placed.groupBy("_label").agg(F.count("*").alias("_n"), F.min("position").alias("_first"))
    sizes = sizes.select(
        F.col("_label").alias("_class"),
        (F.col("_first") - 1 + F.round(F.col("_n") * (1 - test_size))).cast("bigint").alias("_train_end"),
        (F.col("_first") - 1 + F.round(F.col("_n") * (1 - test_size / 2))).cast("bigint").alias("_val_end"),
    )
    sizes = checkpointed(sizes)  # a row per class
    key = F.struct("_draw", "_id")
    borders = (
        placed.join(small_side(sizes, MAX_BROADCAST_CLASSES), F.col("_label").eqNullSafe(F.col("_class")))
        .select(
            "_class",
            F.when(F.col("position") <= F.col("_train_end"), key).alias("_train"),
            F.when(F.col("position") <= F.col("_val_end"), key).alias("_val"),
        )
        .groupBy("_class")
        .agg(F.max("_train").alias("_train"), F.max("_val").alias("_val"))
    )
    borders = small_side(checkpointed(borders), MAX_BROADCAST_CLASSES)
    own = F.struct(draw.alias("_draw"), F.col(row_id).alias("_id"))
    split = F.when(own <= F.col("_train"), SPLITS[0]).when(own <= F.col("_val"), SPLITS[1]).otherwise(SPLITS[2])
    return (
        df.join(borders, F.col(label).eqNullSafe(F.col("_class")))
        .withColumn("split", split)
        .drop("_class", "_train", "_val")
    )


def split_sizes(split: DataFrame, label: str = "label") -> DataFrame:
    """Rows per split and class."""
    return split.groupBy("split", label).agg(F.count("*").alias("n"))
