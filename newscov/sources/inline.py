"""Small constant tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_rows(spark: SparkSession, rows, names) -> DataFrame:
    """A constant table built inside the plan, without shipping rows through Python."""
    structs = [F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names)]) for row in rows]
    return spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))
