"""Share of on-topic articles over time, per outlet and overall.

Inputs have a timestamp ``date``, a ``media`` name and an integer ``label`` (1 = on topic).
"""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newscov.functions.dates import month_name, parse_mixed, period_start
from newscov.functions.labels import lookup
from newscov.scale import attach_totals, key_totals, rolling_rows
from newscov.schemas import STORED_MONTH, require_columns
from newscov.taxonomy import EVERY, OUTLET_COLOURS


def dated_articles(articles: DataFrame, formats: tuple[str, ...] = ()) -> DataFrame:
    """Check for ``date`` and ``label`` and parse textual dates; unreadable dates become null."""
    require_columns(articles, "date", "label")
    if dict(articles.dtypes)["date"] != "string":
        return articles
    return articles.withColumn("date", parse_mixed(F.col("date"), formats))


def with_date_parts(articles: DataFrame) -> DataFrame:
    """Add integer year, month and day."""
    return articles.withColumns({"year": F.year("date"), "month": F.month("date"), "day": F.day("date")})


def drop_empty_text(texts: DataFrame, column: str = "text") -> DataFrame:
    """Drop null texts; empty strings stay."""
    return texts.na.drop(subset=[column])


def null_text_count(texts: DataFrame, column: str = "text") -> DataFrame:
    """Number of rows and of null texts."""
    return texts.agg(F.count("*").alias("rows"), F.count_if(F.col(column).isNull()).alias("null_texts"))


def only_positive(articles: DataFrame, overwrite: bool = False) -> DataFrame:
    """On-topic rows; ``overwrite`` declares every row on topic first."""
    if overwrite:
        return articles.withColumn("label", F.lit(1))
    return articles.where(F.col("label") == 1)


def in_outlet(articles: DataFrame, media: str = EVERY) -> DataFrame:
    """Rows of one outlet."""
    return articles if media == EVERY else articles.where(F.col("media") == media)


def in_dates(articles: DataFrame, start: Date, end: Date) -> DataFrame:
    """Rows from midnight of ``start`` up to midnight of ``end``; later on the end day is out.

    Of articles stored by month only the months in between are read.
    """
    if start > end:
        raise ValueError("the end date lies before the start date")
    if STORED_MONTH in articles.columns:
        months = [F.lit(d.replace(day=1)) for d in (start, end)]
        articles = articles.where(F.col(STORED_MONTH).between(*months))
    bounds = [F.lit(d.isoformat()).cast("timestamp_ntz") for d in (start, end)]
    return articles.where(F.col("date").between(*bounds))


def coverage(articles: DataFrame, period: str = "month") -> DataFrame:
    """Articles, on-topic articles and their percentage per day, week or month."""
    return (
        articles.where(F.col("date").isNotNull())
        .groupBy(period_start(F.col("date"), period).alias("period"))
        .agg(
            F.count("*").alias("total_articles"),
            F.count_if(F.col("label") == 1).alias("articles_climat"),
        )
        .withColumn("ratio", 100.0 * F.col("articles_climat") / F.col("total_articles"))
    )


def total_articles(articles: DataFrame) -> DataFrame:
    """Number of rows, null dates included."""
    return articles.agg(F.count("*").alias("total_articles"))


def _share_columns(threshold: float) -> list[Column]:
    share = F.avg("label") * 100
    return [share.alias("share"), (share > threshold).alias("above_threshold")]


def _evolution_columns(articles: DataFrame, short_days: int, long_days: int) -> list[Column]:
    newest = articles.agg(F.max("date")).scalar()

    def recent(days: int) -> Column:
        return F.avg(F.when(F.col("date") > newest - F.expr(f"INTERVAL {days} DAYS"), F.col("label")))

    points = (recent(short_days) - recent(long_days)) * 100
    return [points.alias("evolution"), (points > 0).alias("rising")]


def _bound_columns() -> list[Column]:
    return [F.min("date").alias("first_date"), F.max("date").alias("last_date")]


def overall_share(articles: DataFrame, threshold: float = 10) -> DataFrame:
    """Percentage of on-topic articles and whether it lies above ``threshold``."""
    return articles.agg(*_share_columns(threshold))


def evolution(articles: DataFrame, short_days: int = 7, long_days: int = 30) -> DataFrame:
    """Mean label of the last days minus that of a longer span, in points."""
    return articles.agg(*_evolution_columns(articles, short_days, long_days))


def date_bounds(articles: DataFrame) -> DataFrame:
    """First and last date."""
    return articles.agg(*_bound_columns())


def kpi_summary(articles: DataFrame, threshold: float = 10, short_days: int = 7, long_days: int = 30) -> DataFrame:
    """Total, share, evolution and date bounds in one row: one pass once the newest date is known."""
    return articles.agg(
        F.count("*").alias("total_articles"),
        *_share_columns(threshold),
        *_evolution_columns(articles, short_days, long_days),
        *_bound_columns(),
    )


def selection_share(articles: DataFrame, start: Date, end: Date, media: str = EVERY) -> DataFrame:
    """Share of on-topic articles within dates and outlet."""
    return overall_share(in_outlet(in_dates(articles, start, end), media))


def outlets(articles: DataFrame) -> DataFrame:
    """Outlet names, sorted."""
    return articles.select("media").where(F.col("media").isNotNull()).distinct().orderBy("media")


def months_present(articles: DataFrame) -> DataFrame:
    """Months that occur, with French names, in calendar order."""
    return (
        articles.where(F.col("date").isNotNull())
        .select(F.month("date").alias("month"), month_name(F.col("date")).alias("month_name"))
        .distinct()
        .orderBy("month")
    )


def filter_values(articles: DataFrame) -> DataFrame:
    """Outlets and months a user can filter by; ``rank`` is the month number, 0 for outlets."""

    def entry(kind: str, value: Column, rank: Column) -> Column:
        return F.struct(F.lit(kind).alias("filter"), value.alias("value"), rank.alias("rank"))

    month = entry("month", month_name(F.col("date")), F.month("date"))
    entries = F.array(entry("media", F.col("media"), F.lit(0)), month)
    return articles.select(F.inline(entries)).where(F.col("value").isNotNull()).distinct()


def per_date_counts(articles: DataFrame) -> DataFrame:
    """Add the articles and on-topic articles of its exact date to every row."""
    counts = {"number_articles": F.count("*"), "number_climate": F.coalesce(F.sum("label"), F.lit(0))}
    return attach_totals(articles, "date", key_totals(articles, "date", counts))


def outlet_date_share(articles: DataFrame) -> DataFrame:
    """Mean label and mean on-topic flag per outlet and exact date."""
    return (
        articles.where(F.col("media").isNotNull() & F.col("date").isNotNull())
        .groupBy("media", "date")
        .agg(
            F.avg("label").alias("label"),
            F.avg(F.when(F.col("label") == 1, 1).otherwise(0)).alias("selected"),
        )
    )


def rolling_share(articles: DataFrame, size: int = 60, legacy: bool = False, chunk: int | None = None) -> DataFrame:
    """Mean of the last ``size`` outlet-date shares, per outlet.

    ``legacy`` lets the window run on from one outlet into the next.
    """
    means = {"proportion": F.avg("label"), "proportion_selected": F.avg("selected")}
    within = None if legacy else ["media"]
    return rolling_rows(outlet_date_share(articles), ["media", "date"], size, means, within, chunk)


def confidence_stats(articles: DataFrame) -> DataFrame:
    """Mean and sample deviation of the confidence of on-topic articles."""
    return only_positive(articles).agg(
        F.avg("confidence").alias("avg_confidence"), F.stddev_samp("confidence").alias("std_confidence")
    )


def rolling_confidence(articles: DataFrame, order: list[str], size: int = 10, chunk: int | None = None) -> DataFrame:
    """Mean and sample deviation over ``size`` on-topic rows; null unless all of them have a confidence."""
    rolled = rolling_rows(
        only_positive(articles).select(*order, "confidence"),
        order,
        size,
        {"_n": F.count("confidence"), "avg_proba": F.avg("confidence"), "std_proba": F.stddev_samp("confidence")},
        chunk=chunk,
    )
    full = F.col("_n") == size
    return rolled.withColumns({c: F.when(full, F.col(c)) for c in ("avg_proba", "std_proba")}).drop("_n")


def with_outlet_colour(df: DataFrame, colours: dict[str, str] | None = None) -> DataFrame:
    """Add the outlet's chart colour; an outlet without one fails the job."""
    colour = lookup(colours or OUTLET_COLOURS, F.col("media"))
    unknown = F.raise_error(F.concat(F.lit("no colour for outlet "), F.coalesce("media", F.lit("null"))))
    return df.withColumn("colour", F.coalesce(colour, unknown))
