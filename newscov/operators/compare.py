"""Side-by-side views of metric tables and models."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newscov.sources.inline import literal_rows
from newscov.taxonomy import MODEL_ENERGY

COMPARED_METRICS = ("precision", "recall", "f1", "top1", "top3")


def paired_by_position(tables: dict[str, DataFrame], row_no: str = "row_no") -> DataFrame:
    """Pair row i of every table with row i of the first, whose ``source`` names the pair.

    Every other column gets its series name as a prefix. Metric tables hold one row per run.
    """

    def prefixed(name: str, table: DataFrame, keep_source: bool) -> DataFrame:
        values = [F.col(c).alias(f"{name}_{c}") for c in table.columns if c not in (row_no, "source")]
        return table.select(row_no, *(["source"] if keep_source else []), *values)

    sides = [prefixed(name, table, i == 0) for i, (name, table) in enumerate(tables.items())]
    return reduce(lambda a, b: a.join(b, row_no), sides)


def metric_comparison(
    tables: dict[str, DataFrame], metrics=COMPARED_METRICS, row_no: str = "row_no"
) -> DataFrame:
    """Long form of paired metric tables: row_no, source, metric, series, value."""
    paired = paired_by_position(tables, row_no)
    entries = [
        F.struct(F.lit(m).alias("metric"), F.lit(name).alias("series"), F.col(f"{name}_{m}").alias("value"))
        for m in metrics
        for name in tables
    ]
    return paired.select(row_no, "source", F.inline(F.array(*entries)))


def model_energy(spark: SparkSession) -> DataFrame:
    """Published size and energy use of the compared models."""
    return literal_rows(spark, MODEL_ENERGY, ["model", "size_b", "wh_per_1000", "open_source"])


def size_energy(models: DataFrame) -> DataFrame:
    """Models of known size with the logarithms both axes are drawn on."""
    return models.where(F.col("size_b").isNotNull()).withColumns(
        {"log_size": F.log10("size_b"), "log_energy": F.log10("wh_per_1000")}
    )


def energy_by_outlet(articles: DataFrame, models: DataFrame) -> DataFrame:
    """Energy each model would need for the on-topic articles of each outlet and month.

    ``models`` are ``size_energy`` rows, of which there are a few; each count meets them as a list.
    """
    counts = (
        articles.where((F.col("label") == 1) & F.col("media").isNotNull() & F.col("date").isNotNull())
        .groupBy("media", F.date_format("date", "yyyy-MM").alias("month"))
        .agg(F.count("*").alias("articles"))
    )
    listed = models.agg(F.array_sort(F.collect_list(F.struct(*models.columns)))).scalar()
    per_model = counts.select("media", "month", "articles", F.inline(listed))
    return per_model.withColumn("corpus_wh", F.col("wh_per_1000") * F.col("articles") / 1000)


def drop_duplicate_columns(df: DataFrame) -> DataFrame:
    """Keep the first of columns with equal content.

    One aggregate takes a digest of each column, whatever its row order; a second compares row by
    row the few columns of one type that agree in it.
    """
    names = df.columns
    types = dict(df.dtypes)
    total = [F.sum(F.xxhash64(F.col(c)).cast("decimal(38,0)")).alias(str(i)) for i, c in enumerate(names)]
    digests = dict(zip(names, df.agg(*total).first()))
    pairs = [
        (a, b) for i, b in enumerate(names) for a in names[:i] if (types[a], digests[a]) == (types[b], digests[b])
    ]
    if not pairs:
        return df
    checks = [F.bool_and(F.col(a).eqNullSafe(F.col(b))) for a, b in pairs]
    same = df.agg(*[c.alias(str(i)) for i, c in enumerate(checks)]).first()
    return df.drop(*{b for i, (_, b) in enumerate(pairs) if same[i]})
