"""Texts are cut into words once for every score, and words are counted in arrays."""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from newscov.functions import text as T
from newscov.operators import detect, guided, linear, topics
from newscov.registry import queries


def _scored(spark, texts):
    model = linear.LinearModel(np.ones(16), np.ones((17, 1)), "french")
    rows = spark.createDataFrame([(n, t, n % 2) for n, t in enumerate(texts)], "id INT, text STRING, label INT")
    return detect.predict(detect.Detector(model, {}, {}), rows)


def test_filters_on_scores_cut_no_text_again(spark, plan):
    pairs = _scored(spark, ["eau et air", "", "l'eau"]).groupBy("label", "climate_related").agg(F.count("*").alias("n"))
    found = plan(pairs.where("climate_related IS NOT NULL"))
    assert found.count("ArrowEvalPython") == found.count("regexp_extract_all") == 1


def test_evaluation_scores_texts_once(spark, plan):
    tables = detect.evaluate(_scored(spark, ["eau", "air", "feu", "sol"]))
    assert not any("ArrowEvalPython" in plan(t) for t in tables.values())
    assert tables["confusion"].select(F.sum(F.col("predicted_0") + F.col("predicted_1"))).first()[0] == 4


def test_counted_words():
    lists = [["b", "a", "b"], None, [], ["é", "a"]]
    got = topics.counted_words(pa.array([["x"], *lists], pa.list_(pa.string())).slice(1)).to_pylist()
    assert got == [
        None if words is None else [{"word": w, "tf": n} for w, n in sorted(Counter(words).items(), key=lambda x: x[0].encode())]
        for words in lists
    ]


def test_counted_buckets():
    lists = [[5, 1, 5, 0], [], [3]]
    got = linear.counted_lists(pa.array([[9], *lists], pa.list_(pa.int32())).slice(1)).to_pylist()
    assert got == [{"buckets": sorted(set(x)), "tfs": [x.count(b) for b in sorted(set(x))]} for x in lists]


def test_repeated_buckets_weigh_as_their_counts():
    idf = np.linspace(1, 2, 8)
    repeated = linear._Rows(pa.array([[5, 1, 5], [2]], pa.list_(pa.int32())), None, idf)
    kinds = pa.list_(pa.int32())
    counted = linear._Rows(pa.array([[5, 1], [2]], kinds), pa.array([[2, 1], [1]], kinds), idf)
    weights = np.arange(9.0)[:, None]
    assert np.allclose(repeated.margins(weights), counted.margins(weights))


def test_clean_tokens_of_odd_words(spark):
    texts = ["abc", "co2 l'eau eau_x été ÉTÉS Ωμεγα Ω naïve don't", "", None, "x́y 12 œuvre ’ '"]
    rows = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "id INT, text STRING")
    stops = T.stop_words("french")
    slow = F.filter(T.letters_only(T.tokens(F.col("text"))), lambda w: ~w.isin(stops))
    found = rows.select("id", T.clean_tokens(F.col("text")).alias("fast"), slow.alias("slow")).orderBy("id").collect()
    assert [r.fast for r in found] == [r.slow for r in found]
    assert found[1].fast == ["omega", "o", "naive", "do"] and found[3].fast is None


def test_topics_of_words_between_unknown_ones(spark):
    lexicon = [("t", "a", "eau douce"), ("t", "b", "douce"), ("t", "c", "mer")]
    texts = [(1, "eau x douce"), (2, "l eau douce"), (3, None), (4, "rien"), (5, "mer mer eau")]
    rows = spark.createDataFrame(texts, "id INT, text STRING")
    got = {(r.id, r.subtheme, r.terms) for r in topics.topic_tags(rows, lexicon, "id").collect()}
    assert got == {(1, "b", 1), (2, "a", 1), (2, "b", 1), (5, "c", 1)}


def test_scores_with_salient_words_cut_texts_once(spark, plan):
    model = linear.LinearModel(np.linspace(1, 2, 16), np.linspace(-1, 1, 17)[:, None], "french")
    rows = spark.createDataFrame([(1, "eau douce eau"), (2, "air et feu"), (2, "sol"), (3, None), (4, "12")], "id INT, text STRING")
    detector = detect.Detector(model, {}, {})
    scored = detect.predict(detector, rows, row_id="id")
    assert "regexp_extract_all" not in plan(scored)  # cut when the lists were written
    plain = sorted((r.id, r.climate_related, round(r.confidence, 9)) for r in detect.predict(detector, rows).collect())
    assert sorted((r.id, r.climate_related, round(r.confidence, 9)) for r in scored.collect()) == plain
    words = {r.id: r.top_words for r in scored.where("id <> 2").collect()}
    assert set(words[1]) == {"eau", "douce"} and words[4] is None and set(words) == {1, 4}


def test_seeded_topics_cut_texts_once(spark, plan, tmp_path):
    texts = ["est sont avec energie", "the and with energy", None, "", "und nicht das", "the energy the energy"]
    rows = [(n % 5, t, "en", "web") for n, t in enumerate(texts * 3)]
    spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING, source STRING").write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.seeded_topics(spark, str(tmp_path))
    assert "regexp_extract_all" not in plan(found)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    alone = guided.guided_tags(guided.fit_topics(docs, queries.SEED_LEXICON), docs, "doc_id")
    listed = [sorted((r.doc_id, r.rank, r.subtheme, round(r.share, 5)) for r in df.collect()) for df in (found, alone)]
    assert listed[0] == listed[1]
