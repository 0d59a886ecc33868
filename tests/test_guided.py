import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from newscov.operators import guided, topics

PLANTED = {
    ("cause", "gaz"): ["methane", "carbone", "cheminee", "usine", "fumee", "moteur", "essence", "diesel"],
    ("solution", "arbres"): ["foret", "plantation", "racine", "feuille", "bois", "graine", "sylve", "pepiniere"],
    ("conséquence", "mer"): ["ocean", "maree", "corail", "vague", "banquise", "littoral", "digue", "sel"],
}
COMMON = ["journee", "semaine", "monde", "ville"]
SEEDS = [(*topic, word) for topic, own in PLANTED.items() for word in own[:2]]


def corpus(n=240):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        topic = list(PLANTED)[i % 3]
        pool = PLANTED[topic][2:] if i % 4 == 0 else PLANTED[topic]  # every fourth text holds no seed
        rows.append((i, " ".join(rng.choice(pool) for _ in range(8)) + " " + " ".join(rng.choices(COMMON, k=4)), *topic))
    return rows


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(corpus(), "id INT, text STRING, theme0 STRING, sub0 STRING").cache()


@pytest.fixture(scope="module")
def model(texts):
    return guided.fit_topics(texts, SEEDS, n_features=1024)


def test_texts_without_seeds_find_their_topic(texts, model):
    tags = guided.guided_tags(model, texts, "id", "theme0", "sub0").where("rank = 1").collect()
    assert len(tags) == 240
    without = [t for t in tags if t["id"] % 4 == 0]
    assert len(without) == 60 and all((t["theme"], t["subtheme"]) == (t["theme0"], t["sub0"]) for t in without)
    tagged = topics.topic_tags(texts.where("id % 4 = 0"), SEEDS, "id")
    assert tagged.count() == 0  # matching alone finds nothing there


def test_topic_words_go_beyond_the_seeds(texts, model):
    rows = guided.topic_words(model, texts, top=12).collect()
    for topic, own in PLANTED.items():
        found = {r["word"] for r in rows if (r["theme"], r["subtheme"]) == topic}
        assert set(own) <= found


def test_equals_dense_rounds(spark, texts, model):
    """The same rounds over a dense matrix of all texts."""
    words = sorted({w for _, text, *_ in corpus() for w in text.split()})
    frame = spark.createDataFrame([(w,) for w in words], "word STRING")
    bucket = {r["word"]: r["b"] for r in frame.select("word", F.pmod(F.xxhash64("word"), F.lit(1024)).alias("b")).collect()}
    x = np.zeros((240, 1024))
    for i, text, *_ in corpus():
        for w in text.split():
            x[i, bucket[w]] += 1
    order = sorted(PLANTED)
    seeds = np.zeros((1024, 3))
    for theme, sub, word in SEEDS:
        seeds[bucket[word], order.index((theme, sub))] += 0.5
    free = (seeds.sum(axis=1, keepdims=True) == 0) * guided.BASE_COUNT
    prior = np.hstack([seeds * guided.SEED_SHARE * x.sum() + free, free])
    spread = free / free.sum()
    phi = np.hstack([guided.SEED_START * seeds, np.zeros((1024, 1))]) + (1 - guided.SEED_START) * spread
    for _ in range(guided.ROUNDS):
        counts = np.zeros_like(phi)
        for row in x:
            theta = np.full(4, 0.25)
            for _ in range(guided.INNER_ROUNDS):
                r = theta * phi
                r /= np.maximum(r.sum(axis=1, keepdims=True), 1e-300)
                theta = row @ r + guided.TEXT_PRIOR
                theta /= theta.sum()
            counts += row[:, None] * r
        phi = (counts + prior) / (counts + prior).sum(axis=0)
    assert model.topics == order
    phi[(x.sum(axis=0) == 0) & (seeds.sum(axis=1) == 0)] = 0
    assert np.allclose(model.weights, phi, atol=1e-9)


def test_odd_texts(spark, model, plan):
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "... 12"), (4, "methane " * 60_000), (4, "methane"), (5, "inconnu")], "id INT, text STRING")
    tags = guided.guided_tags(model, odd, "id")
    assert sorted((r["id"], r["subtheme"]) for r in tags.where("rank = 1").collect()) == [(4, "gaz"), (4, "gaz")]
    assert "Exchange" not in plan(tags)


def random_lexicon(n, rng):
    words = [f"w{i}" for i in range(60)]
    return [(f"t{i % 3}", f"s{i % 7}", " ".join(rng.choices(words, k=rng.randrange(1, 5)))) for i in range(n)], words


def brute_tags(rows, lexicon, top=3):
    out = []
    for key, text in rows:
        padded = f" {' '.join(text.split())} "
        hits = {}
        for theme, sub, term in {(a, b, t) for a, b, t in lexicon}:
            if f" {term} " in padded:
                hits[sub, theme] = hits.get((sub, theme), 0) + 1
        best = sorted(hits, key=lambda k: (-hits[k], k))[:top]
        out += [(key, i + 1, theme, sub, hits[sub, theme]) for i, (sub, theme) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("limit", [topics.LEXICON_BYTES, 0])
def test_automaton_and_join_match_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(topics, "LEXICON_BYTES", limit)
    rng = random.Random(7)
    lexicon, words = random_lexicon(400, rng)
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 40)))) for i in range(60)]
    df = spark.createDataFrame(rows, "id INT, text STRING")
    got = sorted(tuple(r) for r in topics.topic_tags(df, lexicon, "id").collect())
    assert got == brute_tags(rows, lexicon)


def test_a_hundred_thousand_terms(spark, plan):
    lexicon = [(f"t{i % 5}", f"s{i % 97}", f"mot{i} suite{i % 13}" if i % 2 else f"mot{i}") for i in range(100_000)]
    rows = [(i, f"rien mot{2 * i} et mot{2 * i + 1} suite{(2 * i + 1) % 13} mot{2 * i + 3} fin") for i in range(500)]
    df = spark.createDataFrame(rows, "id INT, text STRING")
    tags = topics.topic_tags(df, lexicon, "id")
    assert len(plan(tags)) < 20_000 and "Exchange" not in plan(tags)
    found = {}
    for r in tags.collect():
        found.setdefault(r["id"], set()).add((r["theme"], r["subtheme"], r["terms"]))
    for i in range(500):
        expected = {(f"t{n % 5}", f"s{n % 97}", 1) for n in (2 * i, 2 * i + 1)}
        assert found[i] == expected


def test_failure_links():
    automaton = topics.TermAutomaton({"a b c d": [0], "b c": [1], "c": [2], "b c e": [3]})
    assert automaton.hits("a b c e".split()) == {1: 1, 2: 1, 3: 1}
    assert automaton.hits("a b c d".split()) == {0: 1, 1: 1, 2: 1}
    assert automaton.hits([]) == {}
