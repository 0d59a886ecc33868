"""Filtered, paged drill-down into predictions and category breakdowns.

Inputs have ``date``, ``media`` and the columns of ``PREDICTION_COLUMNS``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newscov.functions.dates import month_number
from newscov.functions.labels import all_in, any_in, explorer_code_of, themes
from newscov.operators.coverage import in_outlet
from newscov.scale import PageIndex, rows_between
from newscov.schemas import PREDICTION_COLUMNS, STORED_MONTH, require_columns
from newscov.sources.inline import literal_rows
from newscov.taxonomy import EVERY, MACRO_CODES, THEMES, explorer_codes

# --- fixed values: columns the explorer does not show ----------------------------
HIDDEN_COLUMNS = (
    "order", "presenter", "editorDeputy", "url",
    "urlTvNews", "containsWordGlobalWarming", "top_words",
    "confidence", "prediction_label", "authors", "editor",
)
# --- end of fixed values -----------------------------------------------------------

PAGE_SIZE = 100


def _default_codes(macro: bool, legacy: bool = False) -> tuple[str, ...]:
    return tuple(sorted(MACRO_CODES)) if macro else explorer_codes(legacy)


def coded_predictions(predictions: DataFrame, columns=PREDICTION_COLUMNS) -> DataFrame:
    """Replace display names by codes in the prediction columns; unknown labels become null."""
    return predictions.withColumns({c: explorer_code_of(F.col(c)) for c in columns})


def in_month(predictions: DataFrame, month: str = EVERY) -> DataFrame:
    """Rows of one month, given by its French name; of rows stored by month only that one is read."""
    if month == EVERY:
        return predictions
    source = STORED_MONTH if STORED_MONTH in predictions.columns else "date"
    return predictions.where(F.month(source) == month_number(month))


def drop_hidden(predictions: DataFrame, macro: bool = False) -> DataFrame:
    """Drop the columns the explorer hides, where present."""
    return predictions.drop(*HIDDEN_COLUMNS, *(PREDICTION_COLUMNS[1:] if macro else ()))


def drop_required(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns that must be there."""
    return require_columns(df, *names).drop(*names)


def explorer_rows(
    predictions: DataFrame,
    categories: list[str] | None = None,
    media: str = EVERY,
    month: str = EVERY,
    selection: list[str] | None = None,
    macro: bool = False,
) -> DataFrame:
    """Rows the explorer works on: outlet, month and category filters, hidden columns gone."""
    columns = list(PREDICTION_COLUMNS[:1] if macro else PREDICTION_COLUMNS)
    rows = drop_hidden(in_month(in_outlet(predictions, media), month), macro)
    if selection:
        rows = rows.where(any_in(columns, selection))
    return rows.where(all_in(columns, categories or _default_codes(macro)))


def page(rows: DataFrame, number: int, order: list[str], size: int = PAGE_SIZE) -> DataFrame:
    """Rows of page ``number`` (from 1) in ``order``, nulls first; ties have a fixed order."""
    first = size * (number - 1)
    return rows_between(rows, order, lambda _: (first + 1, first + size)).orderBy(*order)


def page_index(rows: DataFrame, order: list[str], path: str, size: int = PAGE_SIZE) -> PageIndex:
    """Store where every page of ``rows`` begins and ends; ``page_of`` then reads single pages."""
    return PageIndex.build(rows, order, size, path)


def page_of(index: PageIndex, rows: DataFrame, number: int, order: list[str]) -> DataFrame:
    """``page`` by a stored index: one lookup and one filtered scan, however deep the page lies."""
    return index.page(rows, order, number)


def page_info(rows: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    """Number of rows and of pages; no rows still make one page."""
    n = F.count("*")
    pages = F.greatest(F.ceil(n / size), F.lit(1)).cast("bigint")
    return rows.agg(n.alias("total_rows"), pages.alias("total_pages"))


def long_predictions(rows: DataFrame, columns=PREDICTION_COLUMNS, keep: list[str] | None = None) -> DataFrame:
    """One row per article and prediction column, nulls kept."""
    return rows.unpivot(keep if keep is not None else ["date"], list(columns), "prediction_rank", "category")


def category_counts(
    rows: DataFrame, categories: list[str] | None = None, macro: bool = False, legacy: bool = False
) -> DataFrame:
    """Predictions per category, absent categories as 0.

    ``legacy`` lists the code shared by two names twice.
    """
    spine_codes = categories or _default_codes(macro, legacy)
    columns = PREDICTION_COLUMNS[:1] if macro else PREDICTION_COLUMNS
    counted = (
        long_predictions(rows, columns, keep=[])
        .where(F.col("category").isin(sorted(set(spine_codes))))
        .groupBy("category")
        .agg(F.count("*").alias("n"))
    )
    spine = literal_rows(rows.sparkSession, [(c,) for c in spine_codes], ["category"])
    return (
        spine.join(F.broadcast(counted), "category", "left")  # one row per spine category at most
        .select("category", F.coalesce("n", F.lit(0)).alias("n"))
        .orderBy(F.desc("n"), "category")
    )


def category_share(counts: DataFrame) -> DataFrame:
    """Add each category's percentage of all counted predictions, one decimal.

    The unpartitioned window holds one row per category.
    """
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("percent", F.round(F.try_divide(F.col("n") * 100.0, total), 1))


def category_by_month(rows: DataFrame, selection: list[str] | None = None) -> DataFrame:
    """Predictions per month label (``Jan 2024``) and selected category.

    Without a selection the first three categories by name are taken.
    """
    month = F.date_format("date", "MMM yyyy").alias("month")
    long = long_predictions(rows).where(F.col("category").isNotNull())
    if selection is not None:
        long = long.where(F.col("category").isin(list(selection)))
    counts = long.groupBy(month, "category").agg(F.count("*").alias("n"))
    if selection is None:
        # Ranked after counting: the unpartitioned window holds one row per month and category.
        counts = counts.withColumn("_rank", F.dense_rank().over(Window.orderBy("category")))
        counts = counts.where(F.col("_rank") <= 3).drop("_rank")
    return counts.where(F.col("month").isNotNull())


def themes_by_month(rows: DataFrame, selection: list[str] | None = None, legacy: bool = False) -> DataFrame:
    """Articles per month (``2024-01``) and theme, each article once per theme.

    ``legacy`` counts articles without a date under the month ``NaT``.
    """
    month: Column = F.date_format("date", "yyyy-MM")
    if legacy:
        month = F.coalesce(month, F.lit("NaT"))
    return (
        rows.select(month.alias("month"), F.explode(themes(*PREDICTION_COLUMNS)).alias("theme"))
        .where(F.col("month").isNotNull() & F.col("theme").isin(list(selection or THEMES)))
        .groupBy("month", "theme")
        .agg(F.count("*").alias("n"))
    )
