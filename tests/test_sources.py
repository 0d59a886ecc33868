import json
import re
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newscov import schemas
from newscov.operators.coverage import coverage, dated_articles, in_dates
from newscov.operators.detect import load_detector
from newscov.operators.explore import in_month
from newscov.plans.dashboard import dashboard
from newscov.plans.detection import detect_file, train_detector
from newscov.functions.answers import run_name
from newscov.sources import increments, readers, sinks
from newscov.sources.readers import cast_failures, read_articles

CSV = 'date,media,label,confidence,description\n2024-01-02,TF1,1,0.9,"Il dit ""oui"",\nvraiment"\njuil-24,France2,0,x,\n'


def test_quoted_line_breaks(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(CSV, encoding="utf-8")
    rows = readers.read_articles(spark, str(path), schemas.ARTICLES).collect()
    assert rows[0].description == 'Il dit "oui",\nvraiment'
    assert (rows[0].label, rows[0].confidence, rows[1].confidence, rows[1].description) == (1, 0.9, None, None)
    assert readers.read_any(spark, str(path)).columns == list(schemas.ARTICLES.names)


def test_columns_match_by_name(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("label,extra.x,date\n1,e,2024-01-01\n", encoding="utf-8")
    df = readers.read_articles(spark, str(path), schemas.ARTICLES)
    assert df.columns == ["label", "extra.x", "date"] and tuple(df.first()) == (1, "e", "2024-01-01")


def test_semicolons(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("description;label_1\na,b;pollution\n", encoding="utf-8")
    assert tuple(readers.read_articles(spark, str(path), sep=";").first()) == ("a,b", "pollution")


def test_round_trips(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b",\nc'), (2, None)], "id INT, text STRING")
    for kind, name in (("csv", "out"), ("parquet", "out.parquet")):
        sinks.write_result(df, str(tmp_path / name), kind)
        back = readers.read_any(spark, str(tmp_path / name))
        assert sorted((int(r.id), r.text) for r in back.collect()) == [(1, 'a "b",\nc'), (2, None)]


def test_lists_in_csv(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"], {"k": None})], "id INT, words ARRAY<STRING>, answer MAP<STRING,STRING>")
    sinks.write_result(df, str(tmp_path / "out"), "csv")
    assert readers.read_articles(spark, str(tmp_path / "out")).first()["words"] == '["a","b"]'


def test_lexicon(spark, tmp_path):
    path = tmp_path / "topics.toml"
    path.write_text('[solution]\nsolaire = ["panneau", "Soleil"]\n[cause]\ngaz = ["co2"]\n', encoding="utf-8")
    assert readers.read_lexicon(spark, str(path)) == [
        ("solution", "solaire", "panneau"), ("solution", "solaire", "Soleil"), ("cause", "gaz", "co2"),
    ]


def test_metrics_are_appended(spark, tmp_path):
    row = spark.createDataFrame([("a", 1.0, 2.0, 3.0, 4.0, 5.0, None)], schemas.METRICS)
    for _ in range(2):
        sinks.append_metrics(row, str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).count() == 2


def test_a_repeated_run_leaves_one_copy(spark, tmp_path):
    def row(name, value):
        return spark.createDataFrame([(name, value, 2.0, 3.0, 4.0, 5.0, None)], schemas.METRICS)

    path = str(tmp_path / "m")
    sinks.append_metrics(row("a", 1.0).unionByName(row("b", 1.0)), path, run="r1")
    sinks.append_metrics(row("c", 1.0), path, run="r2")
    sinks.append_metrics(row("a", 9.0), path, run="r1")  # the job ran again
    found = sorted((r["run"], r["source"], r["precision"]) for r in spark.read.parquet(path).collect())
    assert found == [("r1", "a", 9.0), ("r2", "c", 1.0)]


def test_other_runs_stay(spark, tmp_path):
    def runs(*rows):
        return spark.createDataFrame(rows, "model STRING, prompt_method STRING, n_shots INT, recursive BOOLEAN, answer STRING")

    path = str(tmp_path / "r")
    sinks.write_runs(runs(("m", "raw", 0, False, "x"), ("m", "COT", 1, False, "y")), path)
    sinks.write_runs(runs(("m", "raw", 0, False, "z")), path)
    assert sorted(r["answer"] for r in spark.read.parquet(path).collect()) == ["y", "z"]


def articles_of(spark, rows):
    return spark.createDataFrame(rows, "date TIMESTAMP_NTZ, media STRING, label INT")


def some_articles(seed, n=200):
    import random

    rng = random.Random(seed)
    dates = [None, *(datetime(2024, m, d, 5) for m in (1, 2) for d in (1, 9, 30 - m))]
    return [(rng.choice(dates), rng.choice(["a", "b", None]), rng.choice([0, 1, None])) for _ in range(n)]


def test_loads_read_new_files_only(spark, tmp_path):
    source, path, read_names = str(tmp_path / "in"), str(tmp_path / "counts"), []

    def read(spark, files):
        read_names.append(files)
        return spark.read.parquet(*files)

    assert increments.stored_counts(spark, path).count() == 0
    every = []
    for seed in range(3):
        rows = some_articles(seed)
        every += rows
        articles_of(spark, rows).coalesce(2).write.parquet(f"{source}/drop{seed}")
        assert increments.load(spark, source, path, read, "*.parquet") == 2
        assert increments.load(spark, source, path, read, "*.parquet") == 0
    assert len(read_names) == 3 and len({f for names in read_names for f in names}) == 6
    whole = articles_of(spark, every)
    merged = increments.stored_counts(spark, path)
    for period in ("day", "week", "month"):
        stored = sorted(map(tuple, increments.coverage_of(merged, period).collect()))
        assert stored == sorted(map(tuple, coverage(whole, period).collect()))
    shares = {r["media"]: (r["total_articles"], r["articles_climat"]) for r in increments.outlet_share_of(merged).collect()}
    assert shares == {m: (sum(r[1] == m for r in every), sum(r[1] == m and r[2] == 1 for r in every)) for m in ("a", "b", None)}


def test_a_lost_load_counts_once(spark, tmp_path, monkeypatch):
    """The load fails after its counts are written; the next finds more files."""
    source, path = str(tmp_path / "in"), str(tmp_path / "counts")

    def read(spark, files):
        return spark.read.parquet(*files)

    articles_of(spark, some_articles(0)).coalesce(1).write.parquet(f"{source}/a")
    with monkeypatch.context() as broken:
        broken.setattr(type(spark.range(1)), "coalesce", lambda *_: 1 / 0)  # the ledger's write
        with pytest.raises(ZeroDivisionError):
            increments.load(spark, source, path, read, "*.parquet")
    assert increments.stored_counts(spark, path).count() == 0
    articles_of(spark, some_articles(1)).coalesce(1).write.parquet(f"{source}/b")
    assert increments.load(spark, source, path, read, "*.parquet") == 2
    assert increments.stored_counts(spark, path).agg(F.sum("total_articles")).first()[0] == 400


def test_changed_files_are_refused(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "counts")
    source.mkdir()
    (source / "a.csv").write_text("date,media,label\n2024-01-01,a,1\n", encoding="utf-8")

    def read(spark, files):
        return spark.read.option("header", True).csv(files).selectExpr("to_date(date) AS date", "media", "int(label) AS label")

    assert increments.load(spark, str(source), path, read, "*.csv") == 1
    (source / "a.csv").write_text("date,media,label\n2024-01-01,a,1\n2024-01-02,a,1\n", encoding="utf-8")
    with pytest.raises(ValueError, match="a.csv"):
        increments.load(spark, str(source), path, read, "*.csv")


def test_articles_are_stored_by_month(spark, plan, tmp_path):
    raw = spark.createDataFrame([("2024-01-02", 1), ("2024-01-09", 0), ("2024-02-01", 1)], "date STRING, label INT")
    sinks.store_articles(dated_articles(raw), str(tmp_path / "a"))
    january = spark.read.parquet(str(tmp_path / "a")).where("month_start = DATE'2024-01-01'")
    assert january.count() == 2
    assert "PartitionFilters: [isnotnull(month_start" in plan(january)
    stored = spark.read.parquet(str(tmp_path / "a"))
    for part, n in ((in_dates(stored, date(2024, 1, 5), date(2024, 2, 1)), 2), (in_month(stored, "Février"), 1)):
        assert part.count() == n
        assert re.search(r"PartitionFilters: \[[^]]*month_start[^]]*(>=|month\()", plan(part))


def test_runs_are_stored_by_parameters(spark, tmp_path):
    df = spark.createDataFrame([("m", "raw", 0, False, "x")], "model STRING, prompt_method STRING, n_shots INT, recursive BOOLEAN, answer STRING")
    sinks.write_runs(df, str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r")).where("prompt_method = 'raw'").first()["answer"] == "x"


def test_run_names(spark):
    at = datetime(2024, 3, 24, 14, 8, 15)
    assert sinks.run_id(at) == "2024_03_24_14_08_15"
    column = sinks.run_id_column(F.lit("2024-03-24 14:08:15").cast("timestamp"))
    assert spark.range(1).select(column).first()[0] == "2024_03_24_14_08_15"
    assert sinks.run_file_name("ministral8b", "COT", 1, True) == "ministral8b_COT_1shots_recursive"


def test_missing_columns(spark):
    with pytest.raises(KeyError, match="'b', 'c'"):
        schemas.require_columns(spark.createDataFrame([(1,)], "a INT"), "a", "b", "c")


def test_dashboard_from_file(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text(CSV, encoding="utf-8")
    articles = readers.read_articles(spark, str(path), schemas.ARTICLES)
    tables = dashboard(articles, datetime(2024, 1, 1).date(), datetime(2024, 1, 31).date())
    assert [tuple(r)[1:] for r in tables["coverage"].collect()] == [(1, 1, 100.0)]
    assert tables["key_figures"].first()["total_articles"] == 2
    assert tables["selection_share"].first()["share"] == 100.0
    assert tables["rolling_share"].first()["colour"] == "#3266c8"
    assert tables["filter_values"].count() == 3


def test_detection_from_file(spark, tmp_path):
    rows = [(i, "climat chaleur" if i % 3 == 0 else "football match", int(i % 3 == 0)) for i in range(120)]
    texts = spark.createDataFrame(rows, "id INT, text STRING, label INT")
    detector, reports = train_detector(texts, "id", str(tmp_path / "run"), n_features=128)
    assert {r["class"]: r.recall for r in reports["report"].collect()}["accuracy"] == 1.0
    params = json.loads(next(Path(tmp_path / "run/params").glob("*.json")).read_text())
    assert params["len_dataset"] == 120 and params["weights"] == pytest.approx([0.75, 1.5])
    assert spark.read.parquet(str(tmp_path / "run/splits")).groupBy("split").count().count() == 3
    assert spark.read.parquet(str(tmp_path / "run/report")).count() == 5
    texts.write.parquet(str(tmp_path / "in.parquet"))
    detector = load_detector(spark, str(tmp_path / "run/detector"))
    assert set(detector.losses) == {0.01, 0.1} and detector.language == "french"
    source, out = str(tmp_path / "in.parquet"), str(tmp_path / "out")
    scored = detect_file(spark, source, detector, "id", out, label="label", run="r1")
    assert scored.count() == 120 and scored.where("climate_related <> label").count() == 0
    assert spark.read.parquet(f"{out}/r1/inference").count() == 120
    assert spark.read.parquet(f"{out}/r1/confusion").count() == 2


def test_files_with_different_headers(spark, tmp_path):
    a, b = tmp_path / "pred_\u00e9 c+d.csv", tmp_path / "pred_b.csv"
    a.write_text("x,y\n1,un\n2,deux\n", encoding="utf-8")
    b.write_text("y,z,x\ntrois,z3,3\n", encoding="utf-8")
    schema = T.StructType.fromDDL("x INT, y STRING, z STRING")
    rows = read_articles(spark, str(tmp_path), schema, path_column="path")
    assert sorted((r.x, r.y, r.z) for r in rows.collect()) == [(1, "un", None), (2, "deux", None), (3, "trois", "z3")]
    names = {r[0] for r in rows.select(run_name(F.col("path"))).collect()}
    assert names == {"\u00e9 c+d", "b"}


def test_cast_failures(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,un\noops,deux\n,trois\n", encoding="utf-8")
    row = cast_failures(spark, str(tmp_path / "a.csv"), T.StructType.fromDDL("x INT, y STRING")).first()
    assert tuple(row) == (1, 0)
    with pytest.raises(KeyError):
        cast_failures(spark, str(tmp_path / "a.csv"), T.StructType.fromDDL("nothing INT"))
