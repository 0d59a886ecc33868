import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from newscov.operators import batches, compare, prompts
from newscov.plans.classification import classify_articles, classify_with_method
from newscov.taxonomy import DISPLAY_NAMES, MACRO_CODES

# classifiers below use this module's helpers, which Spark's workers cannot import
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def test_output_format():
    assert prompts.output_format(2) == '{"Classe_1": "categorie_1", "Classe_2": "categorie_2"}'
    assert prompts.output_format(1, legacy=True) == "{'Classe_1': 'categorie_{i}'}"


def test_prompts_hold_text_and_categories(spark):
    df = spark.createDataFrame([('un "texte" {text} {k}',)], "text STRING")
    micro, macro = df.select(prompts.micro_prompt(F.col("text")), prompts.macro_prompt(F.col("text"))).first()
    assert 'Texte : "un "texte" {text} {k}"' in micro and micro.endswith("Réponse :\n")
    assert str(list(DISPLAY_NAMES)) in micro and "les 3 classes" in micro
    assert str(list(MACRO_CODES)) in macro and '{ "Classe_1": "categorie"}' in macro


def test_method_messages():
    examples = {"COT": ["un", "deux", "trois"]}
    assert prompts.method_message("COT", 2, examples).endswith("un\ndeux")
    assert "INDICES" in prompts.method_message("CARP")
    with pytest.raises(ValueError):
        prompts.method_message("autre")


def test_prompt_grid(spark, plan):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id INT, text STRING")
    grid = prompts.prompt_table(df, "id", models=("m1", "m2"), shots=(0, 1))
    assert grid.count() == 2 * 2 * 3 * 2
    assert grid.columns == ["id", "user_message", "model", "prompt_method", "n_shots", "system_message"]
    assert "Exchange" not in plan(grid) and "Join" not in plan(grid)


def test_training_text(spark):
    df = spark.createDataFrame([("texte", "Pollution", None, "Biodiversité")], "description STRING, label_1 STRING, label_2 STRING, label_3 STRING")
    text = prompts.training_table(df).first()["training_text"]
    assert json.loads(text.split("Réponse :\n")[-1]) == {"Classe_1": "Pollution", "Classe_2": "None", "Classe_3": "Biodiversité"}
    with pytest.raises(KeyError):
        prompts.training_table(df.drop("label_2"))


def answer(*names):
    return json.dumps({f"Classe_{i}": n for i, n in enumerate(names, 1)}, ensure_ascii=False)


def test_failures_become_null(spark):
    def classify(texts):
        if any("boum" in t for t in texts):
            raise RuntimeError
        return [t.upper() for t in texts]

    df = spark.createDataFrame([(1, "a"), (2, "boum"), (3, "c")], "id INT, text STRING").coalesce(1)
    got = batches.score_batches(df, classify, F.col("text")).orderBy("id").collect()
    assert [r.answer for r in got] == ["A", None, "C"]


def test_classifier_runs_once_per_row(spark, plan):
    scored = batches.score_batches(spark.createDataFrame([("a",)], "text STRING"), lambda t: t, F.col("text"))
    assert plan(scored.where("answer IS NOT NULL").select("answer", "text")).count("EvalPython") == 1


@pytest.mark.parametrize("legacy, expected", [(False, "2"), (True, "1")])
def test_refinement_shows_the_answer(spark, legacy, expected):
    def count(texts):
        # the number of the answer shown, plus one
        shown = [t.split('"Classe_1": "')[-1][0] if "Classe_1" in t else "-1" for t in texts]
        return [f"bla {answer(str(int(s) + 1))}" for s in shown]

    df = spark.createDataFrame([(1, "x")], "id INT, text STRING")
    refined = batches.refined_scores(df, count, F.lit("message"), F.col("text"), passes=2, legacy=legacy)
    assert refined.columns == ["id", "text", "prediction_label"]
    assert refined.first()["prediction_label"] == {"Classe_1": expected}


def test_settled_rows_are_not_asked_again(spark, tmp_path):
    """Row ``n`` changes its answer ``n`` times; calls of each pass are counted in files, as workers share no memory."""
    folder = str(tmp_path)

    def count(texts):
        import os
        import uuid

        out = []
        for t in texts:
            last = int(t.split("\n")[-1])
            shown = int(t.split('"Classe_1": "')[-1][0]) if "Classe_1" in t else -1
            out.append("rien" if last == 9 else answer(str(min(shown + 1, last))))
            open(os.path.join(folder, f"{last}-{shown}-{uuid.uuid4().hex}"), "w").close()
        return out if 8 not in [int(t.split("\n")[-1]) for t in texts] else 1 / 0

    rows = [(i, str(i)) for i in (0, 1, 2, 3, 8, 9)]
    df = spark.createDataFrame(rows, "id INT, text STRING").repartition(6)
    refined = batches.refined_scores(df, count, F.lit("message"), F.col("text"), passes=6)
    got = {r["id"]: r["prediction_label"] for r in refined.collect()}
    assert got == {0: {"Classe_1": "0"}, 1: {"Classe_1": "1"}, 2: {"Classe_1": "2"}, 3: {"Classe_1": "3"}, 8: None, 9: {}}
    import os

    calls = [int(name.split("-")[0]) for name in os.listdir(folder)]
    # first answer, one pass per change, and one that confirms
    assert [calls.count(i) for i in (0, 1, 2, 3)] == [2, 3, 4, 5]


def test_no_passes_and_no_rows(spark):
    df = spark.createDataFrame([(1, "x")], "id INT, text STRING")
    say = lambda texts: [answer("Pollution")] * len(texts)
    assert batches.refined_scores(df, say, F.lit("m"), F.col("text"), passes=0).first()["prediction_label"] == {"Classe_1": "Pollution"}
    assert batches.refined_scores(df.limit(0), say, F.lit("m"), F.col("text"), passes=3).count() == 0


def test_classify_articles(spark):
    def classify(prompts):
        kinds = {
            "complet": "Réponse :\n" + answer("Pollution", "Sécheresse", "x"),
            "partiel": "Réponse :\n" + answer("Pollution"),
            "nul": 'Réponse :\n{"Classe_1": "a", "Classe_2": null, "Classe_3": "b"}',
            "faux": "Réponse :\n{faux}",
        }
        return [p + kinds[next(k for k in kinds if f'"{k}"' in p)] for p in prompts]

    names = ["complet", "partiel", "nul", "faux", "complet"]
    df = spark.createDataFrame([(i, n, int(i < 4)) for i, n in enumerate(names)], "id INT, description STRING, label INT")
    rows = {r.id: r for r in classify_articles(df, classify, ["id"]).collect()}
    assert set(rows) == {0, 1}
    assert rows[1].prediction_label_1 == "Pollution" and rows[1].prediction_label_2 == "[None, None]"
    assert json.loads(rows[0].prediction_label) == {"Classe_1": "Pollution", "Classe_2": "Sécheresse", "Classe_3": "x"}
    # the last fifth of five rows is the off-topic one, which the macro variant takes all the same
    macro = classify_articles(df, classify, ["id"], full=False, macro=True).collect()
    assert [(r.id, r.label) for r in macro] == [(4, 1)]
    assert classify_articles(df, classify, ["id"], full=False).count() == 0


def test_classify_with_method(spark):
    def classify(prompts):
        return [answer("Pollution") if "INDICES" in p and "oui" in p else "{rien}" for p in prompts]

    df = spark.createDataFrame([(1, "oui", 1), (2, "non", 1), (3, "oui", 0)], "id INT, description STRING, label INT")
    rows = classify_with_method(df, classify, ["id"], "CARP", passes=1).collect()
    assert [(r.id, r.prediction_label_1, r.prediction_label_2) for r in rows] == [(1, "Pollution", None)]


METRICS = "row_no INT, source STRING, precision DOUBLE, top1 DOUBLE"


def test_metric_tables_pair_by_position(spark):
    tuned = spark.createDataFrame([(1, "Llama", 68.1, 79.31), (2, "Qwen", 32.27, 37.93)], METRICS)
    base = spark.createDataFrame([(1, "Base-llama", 36.29, 46.43), (2, "base-Qwen", 4.97, 3.45)], METRICS)
    long = compare.metric_comparison({"tuned": tuned, "base": base}, ("precision", "top1"))
    got = {(r.source, r.metric, r.series): r.value for r in long.collect()}
    assert len(got) == 8
    assert got["Qwen", "precision", "base"] == 4.97 and got["Llama", "top1", "tuned"] == 79.31


def test_size_and_energy(spark):
    rows = {r.model: r for r in compare.size_energy(compare.model_energy(spark)).collect()}
    assert len(rows) == 10 and rows["mistral 8x7b"].wh_per_1000 == 615.39
    assert rows["chatgpt_ancien-3.5"].log_size == pytest.approx(2.243038, abs=1e-6)
    extra = spark.createDataFrame([("x", None, 1.0, True)], "model STRING, size_b DOUBLE, wh_per_1000 DOUBLE, open_source BOOLEAN")
    assert compare.size_energy(extra).count() == 0


def test_duplicate_columns(spark):
    df = spark.createDataFrame([(1, 1, 2, "1"), (None, None, 3, None)], "a INT, b INT, c INT, d STRING")
    assert compare.drop_duplicate_columns(df).columns == ["a", "c", "d"]
