"""Article, prediction and lexicon sources. Paths may point to any file system Spark knows."""

from __future__ import annotations

import tomllib
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newscov.schemas import require_columns


def _headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Files below ``path`` by their first line; one row per file reaches the driver."""
    lines = spark.read.text(path)
    if len(files := lines.inputFiles()) == 1:
        return {"": [unquote(files[0])]}
    # the first block of a file begins with its header, and rows of a block keep their order
    numbered = lines.where("_metadata.file_block_start = 0").select(
        "value", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at")
    )
    first = numbered.groupBy("file").agg(F.min_by("value", "at").alias("header"))
    groups: dict[str, list[str]] = {}
    for row in first.orderBy("file").collect():
        groups.setdefault(row["header"].removeprefix("\ufeff"), []).append(unquote(row["file"]))
    return groups


def _text_rows(spark: SparkSession, path: str, sep: str, multi_line: bool, path_column: str | None) -> DataFrame:
    """All columns as text. Files with different headers are read by themselves and meet by name."""
    reader = spark.read.option("header", True).option("sep", sep).option("quote", '"').option("escape", '"')
    reader = reader.option("multiLine", multi_line)
    parts = []
    for files in _headers(spark, path).values():
        rows = reader.csv(files)
        columns = [F.col(f"`{c}`") for c in rows.columns]
        if path_column is not None:  # file names arrive percent-encoded, where a plus is a plus
            name = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
            columns.append(name.alias(path_column))
        parts.append(rows.select(*columns))
    if not parts:
        return reader.csv(path)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_articles(
    spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = ",", multi_line: bool = True,
    path_column: str | None = None,
) -> DataFrame:
    """Delimited text with a header, doubled quotes and, by default, line breaks inside quotes.

    Files with such line breaks cannot be split among tasks: keep them small or store
    them once as Parquet (``store_articles``). Pass ``multi_line=False`` when the texts
    have none. The files of a folder may have different headers; a column that a file lacks is
    null there. Without a schema every column is text, which saves a pass over the files;
    with one, columns are matched by name; cells that do not fit become null, and
    ``cast_failures`` counts them. ``path_column`` adds the file each row is from.
    """
    rows = _text_rows(spark, path, sep, multi_line, path_column)
    kinds = {} if schema is None else {f.name: f.dataType for f in schema.fields}
    return rows.select(*[F.col(f"`{c}`").try_cast(kinds.get(c, T.StringType())).alias(c) for c in rows.columns])


def cast_failures(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", multi_line: bool = True
) -> DataFrame:
    """One row: for each declared column, how many cells hold text that does not fit its type."""
    rows = require_columns(_text_rows(spark, path, sep, multi_line, None), *schema.names)
    lost = [
        F.count_if(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull()).alias(f.name)
        for f in schema.fields
    ]
    return rows.agg(*lost)


def read_any(spark: SparkSession, path: str, **options) -> DataFrame:
    """Parquet when the path says so, delimited text otherwise."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    return read_articles(spark, path, **options)


def read_lexicon(spark: SparkSession, path: str) -> list[tuple[str, str, str]]:
    """Theme, subtheme and term of one TOML keyword file: configuration, parsed on the driver."""
    tree = tomllib.loads(spark.read.text(path, wholetext=True).first()["value"])
    return [(theme, sub, term) for theme, subs in tree.items() for sub, terms in subs.items() for term in terms]
