import numpy as np
import pytest
from pyspark.sql import functions as F

from newscov.functions import text as T
from newscov.operators import categories, detect, evaluate, linear
from newscov.taxonomy import METRIC_CODES

MARKS = {"secheresse": "aride", "pollution": "fumee", "deforestation": "tronconneuse"}
FEATURES = 256


def corpus(n=200):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        codes = [c for c in MARKS if rng.random() < 0.4] or ["pollution"]
        words = [f"mot{chr(97 + rng.integers(26))}{chr(97 + rng.integers(6))}" for _ in range(rng.integers(1, 12))]
        words += [MARKS[c] for c in codes for _ in range(rng.integers(1, 3)) if rng.random() < 0.95]
        rows.append((i, " ".join(rng.permutation(words).tolist()), *(codes + [None, None])[:3]))
    return rows


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(corpus(), "id INT, text STRING, label_1 STRING, label_2 STRING, label_3 STRING").cache()


@pytest.fixture(scope="module")
def ready(texts):
    from newscov.functions.labels import coded_labels

    truth = coded_labels("label_1", "label_2", "label_3")
    return linear.prepared(categories._features(texts, "text", truth, METRIC_CODES, "french", FEATURES), "test-linear")


def matrix(rows, idf):
    """The features by plain loops."""
    x = np.zeros((len(rows), len(idf) + 1))
    for i, row in enumerate(rows):
        for bucket, tf in zip(row["_buckets"], row["_tfs"]):
            x[i, bucket] += tf * idf[bucket]
        length = np.sqrt((x[i] ** 2).sum())
        x[i] *= linear.ROW_LENGTH / length if length else 0
        x[i, -1] = 1
    return x


def plain_fit(x, y, penalty, steps=30_000):
    """Gradient descent until it stands still."""
    w = np.zeros(x.shape[1])
    shrink = np.r_[np.full(x.shape[1] - 1, penalty), 0]
    rate = 1 / (0.25 * np.linalg.eigvalsh(x.T @ x / len(x))[-1] + penalty)
    for _ in range(steps):
        w -= rate * (x.T @ (1 / (1 + np.exp(-x @ w)) - y) / len(x) + shrink * w)
    return w


def test_all_heads_equal_plain_fits(ready):
    rows = ready.collect()
    idf = linear.document_weights(ready, FEATURES)
    df = np.zeros(FEATURES)
    for row in rows:
        df[list(set(row["_buckets"]))] += 1
    assert np.allclose(idf[df > 0], np.log((len(rows) + 1) / (df[df > 0] + 1)) + 1) and not idf[df == 0].any()
    tasks = [METRIC_CODES.index(c) for c in MARKS for _ in range(2)]
    penalties = [0.05, 0.5] * len(MARKS)
    plain = np.ones((len(METRIC_CODES), 2))
    fit = linear.fit(ready, tasks, penalties, idf, plain, "french", max_passes=60, tolerance=1e-5)
    assert fit.passes < 60
    x = matrix(rows, idf)
    for head, (task, penalty) in enumerate(zip(tasks, penalties)):
        expected = plain_fit(x, np.array([r["targets"][task] for r in rows], float), penalty)
        assert np.abs(fit.model.weights[:, head] - expected).max() < 2e-3


def test_candidates_share_passes_and_end_alike(ready):
    idf = linear.document_weights(ready, FEATURES)
    task, plain = METRIC_CODES.index("secheresse"), np.ones((len(METRIC_CODES), 2))

    def fitted(penalties):
        return linear.fit(ready, [task] * len(penalties), penalties, idf, plain, "french", max_passes=12, tolerance=0)

    penalties = [0.01, 0.03, 0.1, 1.0]
    together, alone = fitted(penalties), [fitted([p]) for p in penalties]
    assert together.passes == alone[0].passes == 12
    for head, one in enumerate(alone):
        assert np.allclose(together.model.weights[:, [head]], one.model.weights, atol=1e-9)


def test_losses_are_weighted_and_skip_unknown_targets(spark):
    rows = spark.createDataFrame([([1], [1], [1]), ([2], [3], [0]), ([], [], [None]), ([2], [1], [0])], "_buckets ARRAY<INT>, _tfs ARRAY<INT>, targets ARRAY<INT>")
    weights = np.zeros((5, 1))
    weights[1], weights[2], weights[4] = 0.5, -0.25, 0.1
    model = linear.LinearModel(np.ones(4), weights, "french")
    balance = linear.class_balance(rows, 1)
    assert balance.tolist() == [[0.75, 1.5]]
    losses, _ = linear.losses_and_gradients(rows, model, [0], balance, gradients=False)
    m1, m2 = 8 * 0.5 + 0.1, 8 * -0.25 + 0.1
    assert losses[0] == pytest.approx((1.5 * np.log1p(np.exp(-m1)) + 2 * 0.75 * np.log1p(np.exp(m2))) / 3)
    assert linear.class_balance(rows.where("targets[0] = 1"), 1).tolist() == [[0.0, 0.0]]


def test_matrix_too_large_for_the_driver(ready, monkeypatch):
    monkeypatch.setattr(linear, "MODEL_BYTES", 1000)
    with pytest.raises(ValueError):
        linear.summed(ready, (100, 2), lambda batches, out: None)


def test_slices_add_up(spark, monkeypatch):
    monkeypatch.setattr(linear, "SLICE", 7)

    def task(batches, out):
        for batch in batches:
            for i in batch.column("id").to_pylist():
                out[i % 20, i % 3] += i

    expected = np.zeros((20, 3))
    for i in range(1000):
        expected[i % 20, i % 3] += i
    assert (linear.summed(spark.range(1000).repartition(5), (20, 3), task) == expected).all()


@pytest.fixture(scope="module")
def fitted(texts):
    return categories.fit_categories(texts.where("id % 4 > 1"), texts.where("id % 4 = 1"), n_features=FEATURES, max_passes=25)


def test_categories_of_held_out_texts(spark, texts, fitted, tmp_path):
    assert [c for c, t in zip(fitted.codes, fitted.thresholds) if t is not None] == [c for c in fitted.codes if c in MARKS]
    test = texts.where("id % 4 = 0")
    categories.save_categories(fitted, spark, str(tmp_path / "model"))
    again = categories.load_categories(spark, str(tmp_path / "model"))
    assert np.array_equal(again.model.weights, fitted.model.weights) and again.thresholds == fitted.thresholds
    scored = categories.predict_categories(again, test)
    assert scored.columns == [*texts.columns, "prediction_label_1", "prediction_label_2", "prediction_label_3"]
    metrics = evaluate.multilabel_metrics(evaluate.label_lists(scored)).first()
    assert metrics["f1"] > 85 and metrics["top3"] > 95

    # the same scores by plain loops
    def margin(text, c):
        words = [w for w in T.normalise_word(text).split() if w.isalpha()]
        frame = spark.createDataFrame([(w,) for w in set(words)], "word STRING")
        bucket = {r["word"]: r["b"] for r in frame.select("word", F.pmod(F.xxhash64("word"), F.lit(FEATURES)).alias("b")).collect()}
        x = np.zeros(FEATURES + 1)
        for w in words:
            x[bucket[w]] += fitted.model.idf[bucket[w]]
        x *= linear.ROW_LENGTH / np.sqrt((x**2).sum())
        return x[:-1] @ fitted.model.weights[:-1, c] + fitted.model.weights[-1, c]

    for row in scored.limit(5).collect():
        chances = {
            code: 1 / (1 + np.exp(-margin(row["text"], c))) for c, code in enumerate(fitted.codes) if fitted.thresholds[c] is not None
        }
        ranked = sorted(chances, key=lambda c: -chances[c])
        limit = dict(zip(fitted.codes, fitted.thresholds))
        expected = [c for i, c in enumerate(ranked) if i == 0 or chances[c] >= limit[c]][:3]
        assert [row[f"prediction_label_{i}"] for i in (1, 2, 3)] == (expected + [None] * 3)[:3]


def test_texts_without_words_get_no_category(spark, fitted):
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "!!! 12"), (4, "inconnu"), (5, "aride " * 50_000)], "id INT, text STRING")
    got = {r["id"]: r["prediction_label_1"] for r in categories.predict_categories(fitted, odd).collect()}
    assert got[1] is got[2] is got[3] is None and got[4] in MARKS and got[5] == "secheresse"


def test_thresholds_match_brute_force(spark):
    rng = np.random.default_rng(0)
    chances, targets = rng.random((300, 2)), (rng.random((300, 2)) < 0.3).astype(int)
    targets[:, 1] = 0
    df = spark.createDataFrame([(c.tolist(), t.tolist()) for c, t in zip(chances, targets)], "chances ARRAY<DOUBLE>, targets ARRAY<INT>")
    best, none = categories.best_thresholds(df, ["a", "b"])

    def f1(limit):
        said = chances[:, 0] >= limit
        return 2 * (said & (targets[:, 0] == 1)).sum() / max(said.sum() + targets[:, 0].sum(), 1)

    assert none is None and f1(best) == max(f1(i / 100) for i in range(100))


def test_one_class_cannot_be_learnt(texts):
    with pytest.raises(ValueError):
        categories.fit_categories(texts.withColumn("label_1", F.lit("autre")).drop("label_2", "label_3").withColumns(
            {"label_2": F.lit(None).cast("string"), "label_3": F.lit(None).cast("string")}), texts, n_features=FEATURES)


def test_reasons_add_up_to_the_margin(spark):
    rows = [(i, ("chaleur climat " if i % 3 == 0 else "match score ") + f"mot{chr(97 + i % 9)}", int(i % 3 == 0)) for i in range(90)]
    df = spark.createDataFrame(rows, "id INT, text STRING, label INT")
    # three buckets for a dozen words: words that share one keep shares of their own
    for n_features in (3, 512):
        detector = detect.fit_detector(df.where("id % 5 > 0"), df.where("id % 5 = 0"), n_features=n_features)
        more = df.unionByName(spark.createDataFrame([(100, "", 0), (101, None, 0)], df.schema))
        found = {r["id"]: r for r in detect.reasons(detector, more, "id").collect()}
        counted = linear.with_features(more.where("text IS NOT NULL"), "text", "french", n_features)
        margins = counted.select("id", linear.margins(detector.model, spark, F.col("_words"))[0].alias("m"))
        for r in margins.collect():
            row = found[r["id"]]
            assert row["intercept"] + sum(c["share"] for c in row["contributions"]) == pytest.approx(r["m"])
            assert row["margin"] == pytest.approx(r["m"]) and row["climate_related"] == int(r["m"] > 0)
        assert 101 not in found and found[100]["top_words"] == []
    assert set(found[0]["top_words"]) >= {"chaleur", "climat"} and set(found[1]["top_words"]) >= {"match", "score"}
