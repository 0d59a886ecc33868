import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from newscov.llm import quality as Q

BAD = ["vile", "rotten", "nasty", "filthy"]


def corpus(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.choice([2, 3, 4])))
    rows = []
    for i in range(n):
        grade = rng.choice([0, 1, 2, 2, 2])
        words = [word() for _ in range(rng.choice([6, 40, 300, 2000]))]
        if grade == 0:
            for _ in range(max(2, len(words) // 30)):
                words[rng.randrange(len(words))] = rng.choice(BAD)
        if grade == 1:
            kind = rng.randrange(3)
            words = [[w + "***", w.upper() + "!!", w + " |"][kind] for w in words]
        rows.append((i, " ".join(words), grade))
    return rows


@pytest.fixture(scope="module")
def model():
    rows = corpus(1, 1500)
    tokens = Q.Tokens()
    return Q.fit([Q.features(t, tokens) for _, t, _ in rows], np.array([g for *_, g in rows]))


def test_held_out_accuracy(model):
    weights, theta = model
    tokens, right, clean = Q.Tokens(), [], []
    for _, text, grade in corpus(2, 400):
        score = float(weights[Q.features(text, tokens)].sum())
        kept = 1 / (1 + np.exp(theta[-1] - score)) >= Q.LEAST_LIKELY
        right.append(kept == (grade == 2))
        if grade == 2:
            clean.append(kept)
    assert np.mean(right) > 0.97 and np.mean(clean) > 0.97


def test_thresholds_are_ordered_and_weights_only_lower(model):
    weights, theta = model
    assert (np.diff(theta) > 0).all() and (weights <= 0).all() and 0 < np.count_nonzero(weights) < 20_000


def test_query_path_equals_the_features(spark, model):
    weights, theta = model
    at = np.flatnonzero(weights).astype(np.int32)
    row = [(bytearray(at.tobytes()), bytearray(weights[at].tobytes()), theta.tolist())]
    table = spark.createDataFrame(row, "buckets BINARY, weights BINARY, thresholds ARRAY<DOUBLE>")
    texts = [t for _, t, _ in corpus(3, 60)] + ["", "   ", "|", "été É!! x", "long " * 50_000]
    rows = [(i, t, "g") for i, t in enumerate([*texts, None])]
    docs = spark.createDataFrame(rows, "id INT, text STRING, grade STRING")
    got = {r.id: r.rated for r in Q.grades(docs, table).collect()}
    tokens = Q.Tokens()
    for i, text, _ in rows:
        tails = 1 / (1 + np.exp(theta - float(weights[Q.features(text, tokens)].astype(np.float64).sum())))
        assert got[i].tails == pytest.approx(tails, abs=1e-4)
        assert got[i].grade == pytest.approx(tails.sum(), abs=1e-3)
    assert Q.grades(docs.limit(0), table).columns == ["id", "text", "grade", "rated"]


def test_fit_from_tables(spark):
    rows = corpus(4, 300)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, "x"), (5, "repeated")], "id LONG, text STRING")
    rated = spark.createDataFrame([(i, g) for i, _, g in rows] + [(1, 0), (None, 1), (7, None), (9999, 1)], "id LONG, grade INT")
    model = Q.fit_grades(docs, rated).first()
    assert len(model.thresholds) == Q.GRADES - 1 and model.thresholds[0] < model.thresholds[1]
    bounded = Q.fit_grades(docs, rated, most=10).first()
    assert bounded.thresholds != model.thresholds


def test_no_ratings_find_nothing_poor(spark):
    docs = spark.createDataFrame([(1, "vile")], "id LONG, text STRING")
    model = Q.fit_grades(docs, spark.createDataFrame([], "id LONG, grade INT"))
    assert Q.grades(docs, model).where(Q.selected(F.col("rated.tails"))).count() == 1


def test_rating(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (1, 1), (0, 1), (None, 0), (1, None)], "q INT, t INT")
    assert [r[0] for r in df.select(Q.rating(F.col("q"), F.col("t"))).collect()] == [2, 1, 0, 0, None, None]
