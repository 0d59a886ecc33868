import math
import random

import pytest
from pyspark.sql import functions as F

from newscov.operators import evaluate as E
from newscov.plans.classification import evaluate_files, evaluate_runs
from newscov.schemas import EVALUATION_COLUMNS
from newscov.taxonomy import MACRO_CODES, METRIC_CODES

# Annotated labels (first to third, ? for none) and predicted class of the published macro run.
MACRO_RUN = """
dereglement_climatique politique ? -> ecosystemes
dereglement_climatique politique ? -> dereglement_climatique
dereglement_climatique politique ? -> dereglement_climatique
energie politique pollution -> pollution
dereglement_climatique ? ? -> dereglement_climatique
politique pollution ? -> pollution
? energie politique -> pollution
energie ? ? -> energie
pollution ? ? -> pollution
politique ? ? -> ecosystemes
dereglement_climatique politique ? -> pollution
energie ? ? -> energie
energie politique ? -> politique
pollution ? politique -> pollution
dereglement_climatique ecosystemes ? -> pollution
ecosystemes politique ? -> pollution
dereglement_climatique ? ? -> dereglement_climatique
politique ? ? -> ecosystemes
politique ecosystemes ? -> politique
dereglement_climatique ? ? -> pollution
politique ecosystemes ? -> politique
politique ecosystemes ? -> pollution
ecosystemes politique ? -> ecosystemes
politique ecosystemes ? -> pollution
politique ecosystemes ? -> politique
politique ecosystemes ? -> pollution
politique ecosystemes ? -> pollution
politique ? ? -> ecosystemes
pollution politique ? -> pollution
pollution politique ? -> dereglement_climatique
pollution politique ? -> pollution
"""


@pytest.fixture
def macro_run(spark):
    rows = []
    for line in MACRO_RUN.split("\n"):
        if line:
            truth, _, predicted = line.partition(" -> ")
            labels = [None if label == "?" else label for label in truth.split(" ")]
            rows.append(("text", *labels, predicted, "[None]", "[None]"))
    return spark.createDataFrame(rows, ", ".join(f"{c} STRING" for c in EVALUATION_COLUMNS))


def test_published_macro_metrics(macro_run):
    run = macro_run.withColumn("source", F.lit("macro run"))
    assert tuple(evaluate_runs(run, macro=True).first()) == ("macro run", 74.44, 31.48, 36.65, 54.84, 54.84)


def test_published_macro_metrics_from_files(spark, macro_run, tmp_path):
    for name in ("predictions_Macro-first", "predictions_Macro-second"):
        macro_run.toPandas().to_csv(tmp_path / f"{name}.csv", index=False)
    out = str(tmp_path / "metrics")
    metrics = evaluate_files(spark, str(tmp_path / "*.csv"), macro=True, out=out)
    rows = sorted(tuple(r) for r in metrics.collect())
    assert rows == [(f"Macro-{n}", 74.44, 31.48, 36.65, 54.84, 54.84) for n in ("first", "second")]
    assert sorted(tuple(r) for r in spark.read.parquet(out).collect()) == rows


def test_published_macro_counts(macro_run):
    counts = E.label_counts(E.label_lists(macro_run, macro=True), MACRO_CODES)
    assert {r.label: (r.hit, r.predicted, r.actual) for r in counts.collect()} == {
        "pollution": (6, 15, 7), "ecosystemes": (1, 5, 10), "dereglement_climatique": (4, 5, 8),
        "energie": (2, 2, 5), "politique": (4, 4, 24),
    }


def test_row_order_does_not_matter(macro_run):
    lists = E.label_lists(macro_run, macro=True)
    shuffled = lists.orderBy(F.rand(1)).repartition(3)
    assert E.multilabel_metrics(lists, MACRO_CODES).collect() == E.multilabel_metrics(shuffled, MACRO_CODES).collect()


def brute_metrics(rows, codes, top):
    support = {c: sum(c in t for t, _ in rows) for c in codes}
    total = sum(support.values())
    p = r = f = 0.0
    for c in codes:
        hit, guessed = sum(c in t and c in q for t, q in rows), sum(c in q for _, q in rows)
        p += support[c] * (hit / guessed if guessed else 0)
        r += support[c] * (hit / support[c] if support[c] else 0)
        f += support[c] * (2 * hit / (guessed + support[c]) if guessed + support[c] else 0)
    n = len(rows)
    top1 = sum(bool(q) and q[0] in t for t, q in rows) / n
    top3 = sum(any(x in t for x in q[:top]) for t, q in rows) / n
    unsure = sum(not q for _, q in rows) / n
    return [100 * x for x in (p / total, r / total, f / total, top1, top3, unsure)]


@pytest.mark.parametrize("top", [3, None])
def test_metrics_match_brute_force(spark, top):
    rng = random.Random(4)
    codes = list(METRIC_CODES[:6])
    pool = [*codes, "outside"]
    rows = [
        ([rng.choice(pool) for _ in range(rng.randint(0, 3))], [rng.choice(pool) for _ in range(rng.randint(0, 5))])
        for _ in range(200)
    ]
    lists = spark.createDataFrame([(i % 2, *r) for i, r in enumerate(rows)], "run INT, truth ARRAY<STRING>, predicted ARRAY<STRING>")
    got = {r["run"]: list(r)[1:] for r in E.multilabel_metrics(lists, codes, by=["run"], top=top).collect()}
    for run in (0, 1):
        assert got[run] == pytest.approx(brute_metrics(rows[run::2], codes, top), abs=0.0051)


def test_metrics_take_one_scan_and_one_wide_shuffle(macro_run, plan):
    text = plan(E.multilabel_metrics(E.label_lists(macro_run, macro=True), MACRO_CODES))
    assert text.count("Scan") == 1 and "Join" not in text


def test_missing_columns(macro_run):
    with pytest.raises(KeyError, match="label_3"):
        E.evaluation_columns(macro_run.drop("label_3"))


def test_indicator(spark):
    lists = spark.createDataFrame([(1, ["a", "a", "c"])], "id INT, truth ARRAY<STRING>")
    assert tuple(E.label_indicator(lists, "id", codes=["a", "b", "c"]).first()) == (1, 1, 0, 1)


def test_hallucinations(spark):
    df = spark.createDataFrame(
        [("Pollution", "inventé", None), ("pollution", None, None), ("[None, None]", "Pollution", "x")],
        "prediction_label_1 STRING, prediction_label_2 STRING, prediction_label_3 STRING",
    ).selectExpr("*", "NULL AS label_1", "NULL AS label_2", "NULL AS label_3")
    assert E.hallucinations(df).first()[0] == 2
    assert E.hallucinations(df, legacy=True).first()[0] == 0


def test_metrics_by_run(macro_run):
    runs = macro_run.withColumn("path", F.lit("a/articles_modela_COT_1shots.csv"))
    rows = {r.source: r for r in E.metrics_by_run(runs).collect()}
    assert set(rows) == {"modela_COT_1shots", "chatgpt_ancien"}
    assert tuple(rows["chatgpt_ancien"])[1:] == (51.64, 54.25, 46.51, 63.04, 81.88, 1.45)
    assert E.runs(runs).count() == 1


SCORED = [(0, 0, 0.9), (0, 1, 0.6), (1, 1, 0.8), (1, 1, 0.7), (1, 0, 0.6)]


@pytest.fixture
def scored(spark):
    return spark.createDataFrame(SCORED, "label INT, predicted INT, confidence DOUBLE")


def test_confusion(scored):
    assert [tuple(r) for r in E.confusion(scored).collect()] == [(0, 1, 1), (1, 1, 2)]


def test_class_report(scored):
    rows = {r["class"]: tuple(r)[1:] for r in E.class_report(scored).collect()}
    assert rows["0"] == (0.5, 0.5, 0.5, 2)
    assert rows["1"] == pytest.approx((2 / 3, 2 / 3, 2 / 3, 3))
    assert rows["accuracy"] == pytest.approx((0.6, 0.6, 0.6, 5))
    assert rows["macro avg"] == pytest.approx((7 / 12, 7 / 12, 7 / 12, 5))
    assert rows["weighted avg"] == pytest.approx((0.6, 0.6, 0.6, 5))


def test_report_of_a_class_never_predicted(spark):
    df = spark.createDataFrame([(0, 1), (1, 1)], "label INT, predicted INT")
    rows = {r["class"]: tuple(r)[1:] for r in E.class_report(df).collect()}
    assert rows["0"] == (0.0, 0.0, 0.0, 1)


def test_class_weights(scored):
    assert {r.label: r.weight for r in E.class_weights(scored).collect()} == pytest.approx({0: 5 / 4, 1: 5 / 6})


def test_accuracy_and_loss(scored):
    weight = F.when(F.col("label") == 1, 2.0).otherwise(1.0)
    row = E.accuracy_logloss(scored, weight=weight).first()
    loss = -(math.log(0.9) + math.log(0.4) + 2 * (math.log(0.8) + math.log(0.7) + math.log(0.4))) / 8
    assert tuple(row) == (pytest.approx(0.6), pytest.approx(loss))


def test_half_even_rounding(spark):
    lists = spark.createDataFrame([(["a"], ["a"])] + [([], [])] * 7, "truth ARRAY<STRING>, predicted ARRAY<STRING>")
    # one in eight is 12.5; at two decimals both agree, so only the option's effect on type is of interest
    for half_even in (False, True):
        assert E.multilabel_metrics(lists, ["a"], half_even=half_even).first()["top1"] == 12.5


def test_confusion_of_classes_on_one_side(spark):
    scored = spark.createDataFrame([(0, 1), (0, 0), (0, 2), (None, 1)], "label INT, predicted INT")
    got = E.confusion(scored)
    assert got.columns == ["actual", "predicted_0", "predicted_1", "predicted_2"]
    assert [tuple(r) for r in got.collect()] == [(0, 1, 1, 1), (1, 0, 0, 0), (2, 0, 0, 0)]


def test_log_loss_leaves_unlabelled_rows_out(spark):
    scored = spark.createDataFrame([(1, 1, 0.9), (None, 1, 0.9)], "label INT, predicted INT, confidence DOUBLE")
    row = E.accuracy_logloss(scored).first()
    assert (row.accuracy, round(row.logloss, 3)) == (1.0, 0.105)


def test_codes_and_placeholders_are_not_invented(spark):
    rows = [(METRIC_CODES[-1], None, None), ("[None, None]", "[None]", None), ("inventé", None, None)]
    df = spark.createDataFrame(rows, "prediction_label_1 STRING, prediction_label_2 STRING, prediction_label_3 STRING")
    assert E.hallucinations(df).first()[0] == 1
    assert {r[0] for r in df.collect()} & set(METRIC_CODES)


def test_confusion_of_ids_is_refused(spark, monkeypatch):
    monkeypatch.setattr(E, "MOST_CLASSES", 4)
    rows = spark.range(6).selectExpr("id AS label", "id AS predicted")
    with pytest.raises(ValueError, match="more than 4"):
        E.confusion(rows)
    assert E.confusion(rows.where("label < 4")).count() == 4
