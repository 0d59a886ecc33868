"""The registered query of each operator, and its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newscov.llm import (
    embedding_dedup, fingerprints, html_text, merkle, mixing, ngram_join, oracles, packing, quality, repeats, sharding, spelling,
    url_filter, warc,
)
from newscov.llm.common import stored, table
from newscov.llm.stages import TOKENIZER, quality_model

#: host, path, verdict
URL_RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return repeats.remove_repeats(docs).select(
        "doc_id", "repeats.n_bytes", "repeats.n_removed", "repeats.n_spans", F.sha2("repeats.kept", 256).alias("kept_sha256")
    )


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.grades(docs, quality_model(spark, docs, sf_dir))
    tails = F.col("rated.tails")
    return scored.select(
        "doc_id", F.col("rated.grade").alias("expected_grade"), tails[0].alias("not_toxic"), tails[1].alias("good"),
        quality.selected(tails).alias("kept"),
    )


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "host STRING, path STRING, verdict STRING")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archives(*warc.write_archives(table(spark, sf_dir, "pages")))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    mixed = mixing.mix(stored(sized, "mix-input"), size_column="size")
    return mixed.select(
        "doc_id", "size", "mix.source_size", "mix.target", "mix.taken", F.col("mix.draws.shard").alias("shards"),
        F.col("mix.draws.position").alias("positions"),
    )


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_documents(table(spark, sf_dir, "documents"))


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_manifest(table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


LLM_QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_packing": op2_packing,
    "op3_fingerprints": op3_fingerprints,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_quality": op5_quality,
    "op6_html_text": op6_html_text,
    "op7_url_filters": op7_url_filters,
    "op8_warc": op8_warc,
    "op9_mixing": op9_mixing,
    "op10_ngram_join": op10_ngram_join,
    "op11_sharding": op11_sharding,
    "op12_merkle": op12_merkle,
    "op13_spelling": op13_spelling,
}
LLM_SQL = {
    "op1_embedding_dedup": oracles.OP1,
    "op7_url_filters": oracles.url_filters(URL_RULES),
    "op8_warc": oracles.OP8,
    "op10_ngram_join": oracles.OP10,
    "op11_sharding": oracles.sharding(sharding.SHARDS, sharding.SEED),
    "op12_merkle": oracles.merkle(merkle.ARITY, merkle.FIELDS),
    "op13_spelling": oracles.spelling(spelling.LEAST_LENGTH, spelling.LEAST_COUNT, spelling.FORM_FACTOR),
}
