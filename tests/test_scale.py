import pandas as pd
import pytest
from pyspark.sql import functions as F

from newscov import scale


def test_position_is_the_global_row_number(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), "id").repartition(6)
    placed = scale.with_position(df, "k", "id").toPandas().sort_values(["k", "id"])
    assert placed["position"].tolist() == list(range(1, 5001))


def test_position_of_nothing(spark):
    assert scale.with_position(spark.range(0), "id").count() == 0


def test_position_uses_no_single_task_sort(spark, plan):
    placed = scale.with_position(spark.range(1000), "id")
    # the only one-task window runs over one row per partition
    assert plan(placed).count("Window") == 1
    assert "BroadcastExchange" in plan(placed)


@pytest.mark.parametrize("chunk", [7, 60, 1000])
@pytest.mark.parametrize("within", [None, ["g"]])
def test_rolling_rows_match_pandas(spark, chunk, within):
    rows = [("abc"[i % 3] if i % 5 else "a", i, float(i * 37 % 11)) for i in range(400)]
    df = spark.createDataFrame(rows, "g STRING, i INT, v DOUBLE").repartition(5)
    got = scale.rolling_rows(df, ["g", "i"], 7, {"m": F.avg("v"), "n": F.count("*")}, within, chunk).toPandas()
    want = pd.DataFrame(rows, columns=["g", "i", "v"]).sort_values(["g", "i"], ignore_index=True)
    rolling = (want.groupby("g")["v"] if within else want["v"]).rolling(7, min_periods=1)
    want["m"] = rolling.mean().reset_index(drop=True)
    got = got.sort_values(["g", "i"], ignore_index=True)
    assert len(got) == 400
    assert (got["m"] - want["m"]).abs().max() < 1e-9
    assert got["n"].max() == 7


def hot_rows(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"k{i % 50}" if i % 3 == 1 else None) for i in range(3000)]
    return rows, spark.createDataFrame(rows, "i INT, k STRING")


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_totals_reach_every_row(spark, threshold):
    """Merge join and broadcast give the same."""
    rows, df = hot_rows(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        totals = scale.key_totals(df, "k", {"n": F.count("*"), "top": F.max("i")})
        got = {r.i: (r.k, r.n, r.top) for r in scale.attach_totals(df, "k", totals).collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    frame = pd.DataFrame(rows, columns=["i", "k"])
    n, top = frame.groupby("k")["i"].count(), frame.groupby("k")["i"].max()
    assert len(got) == len(rows)
    assert got == {i: (k, int(n[k]), int(top[k])) if k else (None, None, None) for i, k in rows}


@pytest.mark.parametrize("places", [(1, 10), (5, 5), (8, 60), (1, 60), (0, 3), (58, 99), (61, 70), (4, 2)])
def test_rows_between(spark, places):
    rows = [(None if i % 4 == 0 else i % 5, "ab"[i % 2]) for i in range(60)]
    df = spark.createDataFrame(rows, "k INT, v STRING")
    got = [tuple(r) for r in scale.rows_between(df, ["k"], lambda n: places).collect()]
    order = sorted(-1 if k is None else k for k, _ in rows)
    first, last = max(places[0], 1), min(places[1], 60)
    assert sorted(-1 if k is None else k for k, _ in got) == order[first - 1 : last]
    assert not set(got) - set(rows)


def test_small_side(spark, plan):
    assert scale.small_side(spark.range(5), 5)._jdf.queryExecution().logical().toString().startswith("UnresolvedHint")
    assert "Hint" not in scale.small_side(spark.range(6), 5)._jdf.queryExecution().logical().toString()


def test_checkpoint_folder_comes_from_the_session(spark):
    scale.use_checkpoint_dir(spark)
    assert "checkpoint" in spark.sparkContext.getCheckpointDir()


def test_spread_scan_leaves_wide_inputs_alone(spark, plan):
    narrow, wide = spark.range(100, numPartitions=1), spark.range(100, numPartitions=8)
    assert "Exchange" in plan(scale.spread_scan(narrow, "id"))
    assert "Exchange" not in plan(scale.spread_scan(wide, "id"))


@pytest.mark.parametrize("n", [0, 1, 7, 12, 13, 59, 60, 80])
@pytest.mark.parametrize("most", [scale.MOST_TOP, 5])
def test_first_rows(spark, monkeypatch, n, most):
    monkeypatch.setattr(scale, "MOST_TOP", most)
    rows = [(None if i % 4 == 0 else i % 3, "ab"[i % 2]) for i in range(60)]
    got = [tuple(r) for r in scale.first_rows(spark.createDataFrame(rows, "k INT, v STRING"), ["k"], n).collect()]
    order = sorted(-1 if k is None else k for k, _ in rows)
    assert sorted(-1 if k is None else k for k, _ in got) == order[:n]
    for row in set(got):
        assert got.count(row) <= rows.count(row)


def test_first_rows_sort_no_rows(spark, plan):
    found = plan(scale.first_rows(spark.range(100).withColumn("text", F.lit("x")), ["id"], 10))
    assert "Sort" not in found and "Exchange" not in found


@pytest.mark.parametrize("size", [1, 4, 7, 100])
def test_page_index_holds_every_row_once(spark, tmp_path, size):
    rows = [(None if i % 4 == 0 else i % 5, "ab"[i % 2] if i % 3 else None) for i in range(60)]
    df = spark.createDataFrame(rows, "k INT, v STRING").repartition(3)
    index = scale.PageIndex.build(df, ["k"], size, str(tmp_path / "index"))
    n_pages = -(-60 // size)
    assert tuple(index.info().first()) == (60, n_pages)
    seen, last = [], None
    for number in range(1, n_pages + 1):
        page = [tuple(r) for r in index.page(df, ["k"], number).collect()]
        assert len(page) == min(size, 60 - size * (number - 1))
        keys = [-1 if k is None else k for k, _ in page]
        assert keys == sorted(keys) and (last is None or keys[0] >= last)
        last = keys[-1]
        seen += page
    assert sorted(seen, key=repr) == sorted(rows, key=repr)
    assert index.page(df, ["k"], n_pages + 1).count() == 0


@pytest.mark.parametrize("kind", ["TIMESTAMP_NTZ", "TIMESTAMP", "DATE", "DECIMAL(9,2)", "STRING", "DOUBLE"])
def test_keys_of_any_type_in_any_zone(spark, tmp_path, kind):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        number = "id" if kind in ("DECIMAL(9,2)", "STRING", "DOUBLE") else "TIMESTAMP_NTZ'2024-03-10 01:59:59.123456' + make_interval(0, 0, 0, id)"
        df = spark.range(20).selectExpr("id", f"CAST({number} AS {kind}) AS k")
        index = scale.PageIndex.build(df, ["k"], 6, str(tmp_path / "index"))
        pages = [{r["id"] for r in index.page(df, ["k"], n).collect()} for n in (1, 2, 3, 4)]
        assert [len(p) for p in pages] == [6, 6, 6, 2] and set().union(*pages) == set(range(20))
        assert scale.first_rows(df, ["k"], 7).count() == 7
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_page_index_of_nothing(spark, tmp_path):
    df = spark.createDataFrame([], "k INT, v STRING")
    index = scale.PageIndex.build(df, ["k"], 5, str(tmp_path / "index"))
    assert tuple(index.info().first()) == (0, 1) and index.page(df, ["k"], 1).count() == 0


def test_a_page_is_one_filtered_scan(spark, tmp_path, plan):
    spark.range(1000).selectExpr("id", "cast(id AS STRING) AS v").write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    index = scale.PageIndex.build(df, ["id"], 10, str(tmp_path / "index"))
    found = plan(index.page(df, ["id"], 42))
    assert found.count("Scan parquet") == 1 and "GreaterThanOrEqual(id,410), LessThanOrEqual(id,419)" in found
    assert [r["id"] for r in index.page(df, ["id"], 42).collect()] == list(range(410, 420))
