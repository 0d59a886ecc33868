import pytest

from newscov.operators import splits as S


@pytest.mark.parametrize("n, head, tail", [(141, 112, 28), (196, 156, 39), (29, 23, 5), (3, 2, 0), (0, 0, 0)])
def test_head_and_tail(spark, n, head, tail):
    df = spark.range(n).selectExpr("id", "'x' AS media").repartition(3)
    heads = sorted(r.id for r in S.head_share(df, ["id"]).collect())
    tails = sorted(r.id for r in S.tail_share(df, ["id"]).collect())
    assert heads == list(range(head))
    assert tails == list(range(n - tail, n))


def test_head_over_two_columns(spark):
    df = spark.createDataFrame([(1, 2), (1, 1), (0, 5), (2, 0)], "a INT, b INT")
    assert sorted(tuple(r) for r in S.head_share(df, ["a", "b"], 0.75).collect()) == [(0, 5), (1, 1), (1, 2)]


def test_rows_are_not_sorted_to_be_cut(spark, plan):
    df = spark.range(100)
    text = plan(S.tail_share(df, ["id"]))
    assert "Subquery" in text or "subquery" in text
    main = text.split("Subquery")[0]
    assert "Window" not in main and "Sort" not in main


def test_head_rows(spark):
    assert sorted(r.id for r in S.head_rows(spark.range(1000), ["id"], 400).collect()) == list(range(400))


def test_shares_keep_null_keys(spark):
    df = spark.createDataFrame([(None if i < 10 else i, i) for i in range(100)], "k INT, i INT")
    assert S.head_share(df, ["k"], 0.8).count() == 80
    assert S.tail_share(df, ["k"], 1.0).count() == 100
    assert sorted(r.i for r in S.tail_share(df, ["k"], 0.2).collect()) == list(range(80, 100))


def test_stratified_split(spark):
    df = spark.range(1000).selectExpr("id", "CAST(id % 7 = 0 AS INT) AS label")
    split = S.stratified_split(df, "id").cache()
    assert split.count() == 1000 == split.select("id").distinct().count()
    sizes = {(r.split, r.label): r.n for r in S.split_sizes(split).collect()}
    for label, n in ((0, 857), (1, 143)):
        for name, share in (("train", 0.7), ("val", 0.15), ("test", 0.15)):
            assert abs(sizes[name, label] - share * n) <= 1
    again = S.stratified_split(df.repartition(5), "id")
    assert split.exceptAll(again).count() == 0
    other = S.stratified_split(df, "id", seed=1)
    assert split.exceptAll(other).count() > 0


def test_split_of_a_tiny_class(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, None)], "id INT, label INT")
    assert S.stratified_split(df, "id").count() == 4


def test_split_does_not_shuffle_the_rows(spark, plan):
    df = spark.range(1000).selectExpr("id", "CAST(id % 7 = 0 AS INT) AS label", "repeat('x', 100) AS text")
    text = plan(S.stratified_split(df, "id"))
    assert "BroadcastHashJoin" in text and "hashpartitioning(label" not in text
