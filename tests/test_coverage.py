from datetime import date, datetime

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from newscov.operators import coverage as C

ROWS = [
    (1, datetime(2024, 1, 1, 8), "TF1", 1, 0.9),
    (2, datetime(2024, 1, 1, 20), "TF1", 0, 0.6),
    (3, datetime(2024, 1, 7, 23), "France2", 1, 0.7),
    (4, datetime(2024, 1, 8), "France2", 0, 0.8),
    (5, datetime(2024, 2, 1, 12), "TF1", 1, 0.95),
    (6, None, "TF1", 1, 0.5),
]


@pytest.fixture
def articles(spark):
    return spark.createDataFrame(ROWS, "id INT, date TIMESTAMP_NTZ, media STRING, label INT, confidence DOUBLE")


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_coverage(articles):
    assert rows(C.coverage(articles, "day"), "period")[0] == (date(2024, 1, 1), 2, 1, 50.0)
    assert rows(C.coverage(articles, "week"), "period")[:2] == [
        (date(2024, 1, 1), 3, 2, pytest.approx(66.666667)), (date(2024, 1, 8), 1, 0, 0.0),
    ]
    assert rows(C.coverage(articles, "month"), "period") == [(date(2024, 1, 1), 4, 2, 50.0), (date(2024, 2, 1), 1, 1, 100.0)]


def test_coverage_reads_two_columns(spark, plan, tmp_path):
    spark.createDataFrame(ROWS, "id INT, date TIMESTAMP_NTZ, media STRING, label INT, confidence DOUBLE").write.parquet(
        str(tmp_path / "a")
    )
    text = plan(C.coverage(spark.read.parquet(str(tmp_path / "a")), "month"))
    assert "ReadSchema: struct<date:timestamp_ntz,label:int>" in text
    assert "PushedFilters: [IsNotNull(date)]" in text
    assert text.count("Exchange") == 1


def test_dates_are_parsed(spark):
    raw = spark.createDataFrame([("2024-03-01", 1), ("x", 0)], "date STRING, label INT")
    assert [r.date for r in C.dated_articles(raw).collect()] == [datetime(2024, 3, 1), None]
    with pytest.raises(KeyError, match="label"):
        C.dated_articles(raw.drop("label"))


def test_key_figures(articles):
    row = C.kpi_summary(articles).first()
    assert row["total_articles"] == 6 == C.total_articles(articles).first()[0]
    assert row["share"] == pytest.approx(400 / 6) == C.overall_share(articles).first()["share"]
    # newest is 1 February noon: 7 days keep only it, 30 days keep 7 and 8 January too
    assert row["evolution"] == pytest.approx(100 * (1 - 2 / 3)) == C.evolution(articles).first()["evolution"]
    assert row["above_threshold"] and row["rising"]
    assert tuple(C.date_bounds(articles).first()) == (ROWS[0][1], ROWS[4][1])


def test_evolution_bound_is_strict(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 8), 1), (datetime(2024, 1, 1), 0)], "date TIMESTAMP_NTZ, label INT")
    assert C.evolution(df).first()["evolution"] == pytest.approx(50.0)


def test_date_range_ends_at_midnight(articles):
    kept = C.in_dates(articles, date(2024, 1, 1), date(2024, 1, 8))
    assert [r.id for r in kept.orderBy("id").collect()] == [1, 2, 3, 4]
    kept = C.in_dates(articles, date(2024, 1, 1), date(2024, 1, 1))
    assert kept.count() == 0
    with pytest.raises(ValueError):
        C.in_dates(articles, date(2024, 1, 2), date(2024, 1, 1))


def test_selection(articles):
    row = C.selection_share(articles, date(2024, 1, 1), date(2024, 3, 1), "TF1").first()
    assert row["share"] == pytest.approx(200 / 3)
    assert C.in_outlet(articles, C.EVERY).count() == 6


def test_filter_values(articles):
    assert rows(C.filter_values(articles), "filter", "rank", "value") == [
        ("media", "France2", 0), ("media", "TF1", 0), ("month", "Janvier", 1), ("month", "Février", 2),
    ]
    assert [r.media for r in C.outlets(articles).collect()] == ["France2", "TF1"]
    assert [r.month_name for r in C.months_present(articles).collect()] == ["Janvier", "Février"]


def test_per_date_counts(articles):
    daily = articles.withColumn("date", F.col("date").cast("date"))
    got = {r.id: (r.number_articles, r.number_climate) for r in C.per_date_counts(daily).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (1, 1), 4: (1, 0), 5: (1, 1), 6: (None, None)}


def test_rolling_crosses_outlets_only_in_legacy_mode(spark):
    df = spark.createDataFrame(
        [("A", datetime(2024, 1, 1), 1), ("A", datetime(2024, 1, 2), 1), ("B", datetime(2024, 1, 1), 0)],
        "media STRING, date TIMESTAMP_NTZ, label INT",
    )
    legacy = [r.proportion for r in C.rolling_share(df, legacy=True).orderBy("media", "date").collect()]
    assert legacy == [1.0, 1.0, pytest.approx(0.666667, abs=1e-6)]
    assert [r.proportion for r in C.rolling_share(df).orderBy("media", "date").collect()] == [1.0, 1.0, 0.0]


def test_rolling_confidence(spark):
    df = spark.createDataFrame([(i, 1, float(i)) for i in range(12)] + [(99, 0, 0.5)], "id INT, label INT, confidence DOUBLE")
    got = C.rolling_confidence(df, ["id"], chunk=10).orderBy("id").collect()
    assert [r.avg_proba for r in got] == [None] * 9 + [4.5, 5.5, 6.5]
    assert got[9].std_proba == pytest.approx(3.0277, abs=1e-4)


def test_confidence_stats(articles):
    want = pd.Series([0.9, 0.7, 0.95, 0.5])
    assert tuple(C.confidence_stats(articles).first()) == (pytest.approx(want.mean()), pytest.approx(want.std()))


def test_outlet_without_colour_fails(articles):
    assert {r.colour for r in C.with_outlet_colour(articles).collect()} == {"#3266c8", "#ed2f28"}
    with pytest.raises(PySparkException, match="no colour for outlet"):
        C.with_outlet_colour(articles, {"TF1": "#000000"}).collect()


def test_texts(spark):
    texts = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "id INT, text STRING")
    assert [r.id for r in C.drop_empty_text(texts).collect()] == [1, 3]
    assert tuple(C.null_text_count(texts).first()) == (3, 1)


def test_only_positive(articles):
    assert C.only_positive(articles).count() == 4
    assert C.only_positive(articles, overwrite=True).agg(F.sum("label")).first()[0] == 6
