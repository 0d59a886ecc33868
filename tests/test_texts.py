import math
from collections import Counter
from random import Random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from newscov.functions import text as T
from newscov.operators import detect, topics

TEXTS = [
    (1, "Le gaz à effet de serre et le CO2 : gaz, gaz !"),
    (2, "Solaire et éolien, l'énergie SOLAIRE de demain"),
    (3, "rien du tout"),
    (4, ""),
    (5, None),
    (6, "effet de"),
]

LEXICON = [
    ("cause", "gaz_effet_de_serre", "gaz"),
    ("cause", "gaz_effet_de_serre", "Effet de Serre"),
    ("cause", "gaz_effet_de_serre", "co2"),
    ("solution", "energies", "solaire"),
    ("solution", "energies", "Éolien"),
    ("cause", "autre", "serre"),
]


@pytest.fixture
def texts(spark):
    return spark.createDataFrame(TEXTS, "id INT, text STRING")


def test_topic_tags(texts):
    rows = sorted(tuple(r) for r in topics.topic_tags(texts, LEXICON, "id").collect())
    assert rows == [(1, 1, "cause", "gaz_effet_de_serre", 3), (1, 2, "cause", "autre", 1), (2, 1, "solution", "energies", 2)]


def test_topic_tags_top_and_ties(spark):
    lexicon = [("t", name, word) for name, word in (("d", "un"), ("c", "deux"), ("b", "trois"), ("a", "quatre"))]
    df = spark.createDataFrame([(1, "un deux trois quatre")], "id INT, text STRING")
    assert [r.subtheme for r in topics.topic_tags(df, lexicon, "id", top=3).orderBy("rank").collect()] == ["a", "b", "c"]


def test_topic_tags_do_not_shuffle(texts, plan):
    assert "Exchange" not in plan(topics.topic_tags(texts, LEXICON, "id"))


def test_long_text_takes_linear_time(spark):
    # 200,000 words; anything quadratic in the text would not come back
    df = spark.createDataFrame([(1, "effet de serre autre " * 50_000)], "id INT, text STRING")
    row = topics.topic_tags(df, LEXICON, "id").orderBy("rank").first()
    assert (row.subtheme, row.terms) == ("autre", 1)
    assert topics.word_lists(df, "id").selectExpr("inline(words)").where("word = 'serre'").first()["tf"] == 50_000


def brute_salient(rows, stops, top=3):
    docs = {}
    for key, text in rows:
        plain = T.normalise_word(text or "")
        words = "".join(c if c.isalnum() or c in "_'’" else " " for c in plain).split()
        docs[key] = Counter(w for w in words if w.isalpha() and w not in stops)
    df = Counter(w for words in docs.values() for w in words)
    out = set()
    for key, words in docs.items():
        weights = [(-round(tf * math.log((len(rows) + 1) / (df[w] + 1)), 6), w) for w, tf in words.items()]
        out |= {(key, w, -x, i + 1) for i, (x, w) in enumerate(sorted(weights)[:top])}
    return out


def test_salient_words_match_brute_force(texts):
    stops = set(T.stop_words("french"))
    got = {(r.id, r.word, r.weight, r["rank"]) for r in topics.salient_words(texts, "id").collect()}
    want = brute_salient(TEXTS, stops)
    assert {(a, b, d) for a, b, _, d in got} == {(a, b, d) for a, b, _, d in want}
    assert sorted(x[2] for x in got) == pytest.approx(sorted(x[2] for x in want), abs=1e-6)


def test_word_counts(texts):
    got = {(r.id, w.word): w.tf for r in topics.word_lists(texts, "id").collect() for w in r.words or ()}
    assert got[1, "gaz"] == 3 and got[2, "solaire"] == 2
    assert not any(key[0] in (4, 5) for key in got)


def test_word_counts_need_no_shuffle(texts, plan):
    assert "Exchange" not in plan(topics.word_lists(texts, "id"))


def test_top_words_are_ranked(texts):
    lists = {r.id: r.top_words for r in topics.top_words(topics.salient_words(texts, "id"), "id").collect()}
    assert lists[1][0] == "gaz" and len(lists[1]) == 3


def test_detector_learns_and_reports(spark, plan):
    rows = [(i, ("climat chaleur rechauffement " if i % 4 == 0 else "football match score ") + f"mot{i % 9}", int(i % 4 == 0)) for i in range(200)]
    df = spark.createDataFrame(rows, "id INT, text STRING, label INT")
    detector = detect.fit_detector(df.where("id % 5 > 0"), df.where("id % 5 = 0"), penalties=(0.001, 0.1), n_features=256)
    assert set(detector.losses) == {0.001, 0.1}
    scored = detect.predict(detector, df.where("id % 5 = 0").unionByName(df.limit(1).withColumn("text", F.lit(None).cast("string"))), row_id="id")
    assert scored.count() == 40
    assert scored.columns == ["id", "label", "climate_related", "confidence", "top_words"]
    moved = [line for line in plan(scored).split("\n") if "Exchange" in line]
    assert moved and not any("text" in line for line in moved)
    assert set(detector.weights) == {0.0, 1.0}
    assert scored.where("climate_related <> label").count() == 0
    assert scored.where("confidence NOT BETWEEN 0.5 AND 1").count() == 0
    report = detect.evaluate(scored)
    assert {r["class"]: r.f1 for r in report["report"].collect()}["accuracy"] == 1.0
    assert [tuple(r) for r in report["confusion"].collect()] == [(0, 30, 0), (1, 0, 10)]
    assert report["loss"].first()["accuracy"] == 1.0
    weighted = detect.evaluate(scored, weights={0.0: 1.0, 1.0: 0.0})["loss"].first()["logloss"]
    of_zero = detect.evaluate(scored.where("label = 0"))["loss"].first()["logloss"]
    assert weighted == pytest.approx(of_zero)


def _as_before(rows, row_id, top=3):
    """Salient words by a plain join of all entries with all document counts."""
    lists = topics.word_lists(rows, row_id)
    entries = lists.select(row_id, F.inline("words"))
    df = entries.groupBy("word").agg(F.count("*").alias("df"))
    weight = F.round(F.col("tf") * F.log((F.lit(lists.count()) + 1) / (F.col("df") + 1)), 6)
    best = Window.partitionBy(row_id).orderBy(F.desc("weight"), "word")
    ranked = entries.join(df, "word").select(row_id, "word", weight.alias("weight")).withColumn("rank", F.row_number().over(best))
    return sorted(map(tuple, ranked.where(F.col("rank") <= top).collect()), key=repr)


@pytest.mark.parametrize("frequent", [0, 1, 7, 100_000])
def test_salient_words_with_any_share_of_frequent_words(spark, monkeypatch, frequent):
    random = Random(5)
    names = [a + b for a in "abcdefgh" for b in ("lune", "mer", "ciel")] + ["élan", "zz"]
    rows = [(random.choice([*range(40), None]), " ".join(random.choices(names, weights=range(1, 27), k=random.randrange(30)))) for _ in range(90)]
    rows += [(7, None), (8, ""), (9, "le la"), (3, "seul"), (3, "seul")]  # ids come again or are null
    texts = spark.createDataFrame(rows, "id INT, text STRING")
    monkeypatch.setattr(topics, "FREQUENT_WORDS", frequent)
    assert sorted(map(tuple, topics.salient_words(texts, "id").collect()), key=repr) == _as_before(texts, "id")


def test_few_entries_of_frequent_words_are_shuffled():
    words = [[{"word": f"w{n:03d}", "tf": n} for n in range(1, 200)], None, [], [{"word": "w001", "tf": 1}, {"word": "selten", "tf": 1}]]
    frequent = pa.array([f"w{n:03d}" for n in range(1, 200)])
    kind = pa.list_(pa.struct([("word", pa.string()), ("tf", pa.int32())]))
    for lists in (pa.array(words, kind), pa.array([[{"word": "x", "tf": 1}], *words], kind).slice(1)):
        found = topics.leading_words(lists, frequent, np.full(199, 2), 9, 3).to_pylist()
        assert found[0] == [{"word": f"w{n}", "tf": n, "known": 2} for n in (197, 198, 199)]
        assert found[1:3] == [[], []]
        assert found[3] == [{"word": "w001", "tf": 1, "known": 2}, {"word": "selten", "tf": 1, "known": None}]
