import os
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from check import connect, differences
from newscov.llm import mixing, ngram_join, quality, stages
from newscov.llm.registry import LLM_QUERIES, LLM_SQL

SF_DIR = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
DOCUMENTS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG"


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}", len(t or "")) for i, t in texts], DOCUMENTS)


def test_every_operator_is_registered():
    numbers = sorted(int(name.split("_")[0][2:]) for name in LLM_QUERIES)
    assert numbers == list(range(1, 14))
    assert set(LLM_QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(LLM_SQL) <= set(entry.oracle_sql())
    assert len(corpus_pipeline.STAGES) == 5


@needs_data
@pytest.mark.parametrize("name", sorted(LLM_SQL))
def test_query_equals_its_sql(spark, name):
    assert differences(spark, connect(SF_DIR), SF_DIR, name) is None


@needs_data
@pytest.mark.parametrize("name", sorted(set(LLM_QUERIES) - set(LLM_SQL)))
def test_query_gives_each_document_once(spark, name):
    rows = LLM_QUERIES[name](spark, SF_DIR)
    table = "pages" if "page_id" in rows.columns else "documents"
    ident = "page_id" if table == "pages" else "doc_id"
    every = spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(ident)
    assert rows.select(ident).distinct().count() == every.count()
    assert name == "op2_packing" or rows.count() == every.count()


@needs_data
def test_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    good = stages.good_documents(spark, docs, SF_DIR).cache()
    assert good.columns == columns
    rejected = labels.where("toxic = 1").join(good, "doc_id").count()
    clean = labels.where("toxic = 0 AND quality = 1")
    assert rejected <= 0.1 * labels.where("toxic = 1").count()
    assert clean.join(good, "doc_id").count() >= 0.97 * clean.count()
    single = stages.distinct_documents(spark, good, SF_DIR).cache()
    assert single.columns == columns and 0 < single.count() < good.count()
    assert ngram_join.near_documents(single).where("n_links > 0").count() == 0
    clean_texts = stages.unrepeated_texts(spark, single, SF_DIR).cache()
    assert clean_texts.columns == columns and clean_texts.count() == single.count()
    assert clean_texts.where("n_chars <> length(text)").count() == 0
    mixed = stages.mixed_documents(spark, clean_texts, SF_DIR).cache()
    assert mixed.columns == columns
    packed = stages.packed_pieces(spark, mixed, SF_DIR)
    assert packed.select("doc_id").distinct().count() == mixed.select("doc_id").distinct().count()


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    """A near copy goes even if another row of its id stays, and of two rows of one id that are near copies one stays."""
    first = " ".join(f"w{i}" for i in range(60))
    near, other, third = first.replace("w59", "x"), " ".join(f"o{i}" for i in range(40)), " ".join(f"t{i}" for i in range(50))
    rows = [
        (1, first), (3, other), (3, near), (7, third), (7, third.replace("t0 ", "y ")), (7, third), (9, None), (9, ""), (None, first),
        (None, first),
    ]
    got = sorted(((r["doc_id"], r["text"]) for r in stages.distinct_documents(spark, documents(spark, rows), SF_DIR).collect()), key=repr)
    assert [(i, t) for i, t in got if i in (1, 3)] == [(1, first), (3, other)]
    assert sum(i == 7 for i, _ in got) == 1 and sum(i == 9 for i, _ in got) == 2 and sum(i is None for i, _ in got) == 2


def test_one_document_of_each_group_stays(spark):
    text = " ".join(map(str, range(100)))
    near = text.replace("50", "fifty")
    texts = [(1, text), (2, near), (3, text), (3, text), (4, "other words that nobody else has"), (5, None), (6, ""), (6, "")]
    docs = documents(spark, texts).unionByName(documents(spark, [(0, text)]).withColumn("doc_id", F.lit(None).cast("long")))
    kept = sorted(((r.doc_id, r.text) for r in stages.distinct_documents(spark, docs, SF_DIR).collect()), key=repr)
    assert kept == sorted([(1, text), (4, "other words that nobody else has"), (5, None), (6, ""), (None, text)], key=repr)


def test_repeated_passages_go_and_documents_stay(spark):
    passage = "".join(f"{i} é " for i in range(80))
    docs = documents(spark, [(1, "one " + passage), (2, passage + " two"), (3, "three"), (4, None)])
    got = {r.doc_id: (r.text, r.n_chars) for r in stages.unrepeated_texts(spark, docs, SF_DIR).collect()}
    assert got[1][0].strip() == "one" and got[2][0].strip() == "two" and got[3] == ("three", 5) and got[4] == ("", 0)


def drawn(spark, sf_dir):
    """Shard and position of every copy of a document, as the registered query gives them."""
    rows = LLM_QUERIES["op9_mixing"](spark, sf_dir).collect()
    return sorted((s, p, r.doc_id) for r in rows for s, p in zip(r.shards, r.positions, strict=True))


def test_the_mix_is_dealt_to_shards_and_shuffled(spark, tmp_path, monkeypatch):
    rng = random.Random(3)
    docs = documents(spark, [(i, " ".join(["word"] * rng.randrange(1, 1500))) for i in range(600)])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    draws = drawn(spark, str(tmp_path))
    assert len({shard for shard, *_ in draws}) > 8
    stage = stages.mixed_documents(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))
    assert stage.columns == docs.columns
    assert [r.doc_id for r in stage.collect()] == [i for *_, i in draws]
    alone = lambda quotas, shards, seed: split_quotas(quotas, 1, seed)
    split_quotas = mixing.split_quotas
    monkeypatch.setattr(mixing, "split_quotas", alone)
    assert drawn(spark, str(tmp_path)) != draws


def test_empty_documents(spark):
    empty = documents(spark, [])
    for stage in (stages.distinct_documents, stages.unrepeated_texts, stages.mixed_documents, stages.packed_pieces):
        assert stage(spark, empty, SF_DIR).collect() == []
    model = quality.fit_grades(empty.select(F.col("doc_id").alias("id"), "text"), spark.createDataFrame([], "id LONG, grade INT"))
    assert quality.grades(empty, model).collect() == []
