"""Coverage dashboard: trends, key figures and a filtered close-up."""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import DataFrame

from newscov.operators import coverage as C


def dashboard(
    articles: DataFrame,
    start: Date,
    end: Date,
    period: str = "month",
    media: str = C.EVERY,
    colours: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Tables of the dashboard from raw articles with textual dates."""
    dated = C.dated_articles(articles)
    selected = C.in_outlet(C.in_dates(dated, start, end), media)
    return {
        "coverage": C.coverage(dated, period),
        "key_figures": C.kpi_summary(dated),
        "filter_values": C.filter_values(dated),
        "selection_share": C.overall_share(selected),
        "rolling_share": C.with_outlet_colour(C.rolling_share(selected), colours),
    }
