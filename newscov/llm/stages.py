"""The stages of the corpus pipeline: each takes and returns documents, the last packed pieces."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newscov.llm import mixing, ngram_join, packing, quality, repeats
from newscov.llm.common import stored, table
from newscov.scale import with_position

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Model of the grades that ``labels`` gives: toxic, poor, good."""
    labels = table(spark, sf_dir, "labels")
    rated = labels.select(F.col("doc_id").alias("id"), quality.rating(F.col("quality"), F.col("toxic")).alias("grade"))
    return quality.fit_grades(docs.select(F.col("doc_id").alias("id"), "text"), rated)


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are probably neither toxic nor poor."""
    scored = quality.grades(docs, quality_model(spark, docs, sf_dir))
    return scored.where(quality.selected(F.col("rated.tails"))).select(*docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that near-duplicate links join, the one with the smallest id; all with a null id.

    Rows that share an id and a text are one document. Rows that share an id alone are documents of their own: where
    there are any, documents are numbered in the order of their ids and texts, and the numbers stand for the ids. What
    stays is joined to the documents, so texts move once.
    """
    named, unnamed = docs.where("doc_id IS NOT NULL"), docs.where("doc_id IS NULL")
    number = "doc_id"
    if not named.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").isEmpty():
        number = "_number"
        single = named.dropDuplicates(["doc_id", "text"]).withColumn("_digest", F.sha2(F.col("text").cast("binary"), 256))
        single = stored(single, "distinct-rows")
        numbers = with_position(single.select("doc_id", "_digest"), F.struct("doc_id", "_digest"), name=number)
        numbers = numbers.select(F.col("doc_id").alias("_id"), F.col("_digest").alias("_of"), number)
        met = (F.col("doc_id") == F.col("_id")) & F.col("_digest").eqNullSafe(F.col("_of"))
        named = stored(single.join(numbers, met).select(*docs.columns, number), "distinct-numbers")
    kept = ngram_join.near_documents(named, id_column=number).where("kept").select(number)
    return named.join(kept.hint("merge"), number).select(*docs.columns).unionByName(unnamed)


def unrepeated_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the bytes that repeat elsewhere; characters that lost a byte go too."""
    cleaned = repeats.remove_repeats(docs).withColumn("text", F.col("repeats.text"))
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix draws it, so that sources reach their target shares.

    Rows come shard by shard, each in the order of its positions. Ranges of that order rather than
    whole shards are dealt to tasks, as a shard grows with the documents.
    """
    copies = mixing.mixture(mixing.mix(docs))
    ordered = copies.repartitionByRange("shard", "position").sortWithinPartitions("shard", "position")
    return ordered.select(*docs.columns)


def packed_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document's tokens lies in which sequence."""
    return packing.pack(docs, TOKENIZER)
