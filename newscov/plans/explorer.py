"""Category explorer: filtered rows, one page of them and breakdowns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from newscov.operators import explore as X
from newscov.operators.coverage import filter_values
from newscov.taxonomy import EVERY


def explorer(
    predictions: DataFrame,
    order: list[str],
    page: int = 1,
    media: str = EVERY,
    month: str = EVERY,
    selection: list[str] | None = None,
    categories: list[str] | None = None,
    shown_categories: list[str] | None = None,
    shown_themes: list[str] | None = None,
    macro: bool = False,
    legacy: bool = False,
) -> dict[str, DataFrame]:
    """Tables of the explorer from predictions with parsed dates.

    ``shown_categories`` and ``shown_themes`` pick what the month breakdowns hold; by default
    the first three categories and all themes. Macro predictions keep their spelling and have
    no month breakdowns.
    """
    coded = predictions if macro else X.coded_predictions(predictions)
    rows = X.explorer_rows(coded, categories, media, month, selection, macro)
    counts = X.category_counts(rows, categories, macro, legacy)
    tables = {
        "filter_values": filter_values(predictions),
        "page": X.page(rows, page, order),
        "page_info": X.page_info(rows),
        "category_share": X.category_share(counts),
    }
    if not macro:
        tables["category_by_month"] = X.category_by_month(rows, shown_categories)
        tables["themes_by_month"] = X.themes_by_month(rows, shown_themes, legacy)
    return tables
