"""Seeded topics: words that occur with a lexicon's terms gain weight for their topic.

Texts are mixtures of topics, topics are distributions over hashed words. A lexicon gives every topic a prior on the words of
its terms; one more topic without seeds takes what belongs to none. Expectation-maximisation over whole texts
then spreads weight from the seeds to the words they occur with, so a text without any term of
the lexicon can still be told its topic.

Every round is one pass over the hashed counts (``linear.summed``); the word weights, ``features * topics`` doubles, are
broadcast and checked against ``linear.MODEL_BYTES``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newscov.functions.text import clean_tokens
from newscov.operators import linear
from newscov.operators.linear import ENTRIES, bucket_counts, parts_of  # by name: tasks take functions along, not modules
from newscov.operators.topics import Lexicon
from newscov.scale import written

N_FEATURES = 1 << 16
ROUNDS = 8
#: Rounds that settle a text's mixture while the word weights stand still.
INNER_ROUNDS = 5
#: Weight of a seed in its topic's prior, as a share of all words counted, and of any other word.
SEED_SHARE, BASE_COUNT = 0.002, 0.01
#: Share of a topic's words that its seeds are before the first round.
SEED_START = 0.5
#: Words every topic has in a text before the first is read.
TEXT_PRIOR = 0.1


@dataclass
class GuidedModel:
    """Topics ``(theme, subtheme)`` and word weights ``(features, topics + 1)``; the last column is the topic without seeds."""

    topics: list[tuple[str, str]]
    weights: np.ndarray
    language: str


def _mixtures(row: np.ndarray, bucket: np.ndarray, tf: np.ndarray, n: int, weights: np.ndarray, rounds: int) -> tuple:
    """Words of every topic in ``n`` texts given as entries, and the topics' shares of every entry.

    A word without weight in any topic counts for none.
    """
    n_topics = weights.shape[1]
    mixture = np.full((n, n_topics), 1 / n_topics)
    of_word = weights[bucket]
    for _ in range(rounds):
        shares = mixture[row] * of_word
        shares /= np.maximum(shares.sum(axis=1, keepdims=True), 1e-300)
        counted = np.stack([np.bincount(row, tf * shares[:, t], n) for t in range(n_topics)], axis=1)
        mixture = counted + TEXT_PRIOR
        mixture /= mixture.sum(axis=1, keepdims=True)
    return counted, shares


def _entries(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.diff(batch.column("buckets").offsets.to_numpy())
    bucket = batch.column("buckets").flatten().to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(batch.num_rows), sizes), bucket, batch.column("tfs").flatten().to_numpy(zero_copy_only=False).astype(float)


def seed_table(spark: SparkSession, lexicon: Lexicon, language: str, n_features: int) -> tuple[list[tuple[str, str]], np.ndarray]:
    """Topics of a lexicon and ``(features, topics)`` with each topic's share of its seeds; a term's words share its weight.

    The lexicon is configuration: its words are hashed by the expressions that hash the texts.
    """
    topics = sorted({(theme, subtheme) for theme, subtheme, _ in lexicon})
    number = {topic: n for n, topic in enumerate(topics)}
    rows = spark.createDataFrame([(number[a, b], term) for a, b, term in lexicon], "topic INT, term STRING")
    found = rows.withColumn("words", clean_tokens(F.col("term"), language))
    spread = found.select("topic", F.size("words").alias("n"), F.explode("words").alias("word"))
    bucket = F.pmod(F.xxhash64("word"), F.lit(n_features)).cast("int")
    seeds = np.zeros((n_features, len(topics)))
    for r in spread.select("topic", "n", "word", bucket.alias("bucket")).distinct().collect():
        seeds[r["bucket"], r["topic"]] += 1 / r["n"]
    return topics, seeds / np.maximum(seeds.sum(axis=0), 1e-300)


def topic_counts(texts: DataFrame, *keep: str, text: str = "text", language: str = "french", n_features: int = N_FEATURES) -> DataFrame:
    """``keep``, the different hashed words of each text, ``buckets``, and their counts, ``tfs``, held in the checkpoint folder.

    For those who fit and tag the same texts, which are cut into words once then.
    """
    counted = linear.with_bucket_counts(texts.select(*keep, text), text, language, n_features)
    return written(counted.select(*keep, F.col("_buckets").alias("buckets"), F.col("_tfs").alias("tfs")), "topic-counts")


def fit_topics(
    texts: DataFrame, lexicon: Lexicon, text: str = "text", language: str = "french", n_features: int = N_FEATURES, rounds: int = ROUNDS
) -> GuidedModel:
    """Learn the words of a lexicon's topics from texts."""
    return fit_counts(topic_counts(texts, text=text, language=language, n_features=n_features), lexicon, language, n_features, rounds)


def fit_counts(counts: DataFrame, lexicon: Lexicon, language: str = "french", n_features: int = N_FEATURES, rounds: int = ROUNDS) -> GuidedModel:
    """``fit_topics`` from ``topic_counts`` of the same language and number of features."""
    topics, seeds = seed_table(counts.sparkSession, lexicon, language, n_features)
    counted = counts.select("buckets", "tfs")
    total = counted.agg(F.sum(F.aggregate("tfs", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    # a seed is closed to all topics but its own; any other word is open to all
    free = (seeds.sum(axis=1, keepdims=True) == 0) * BASE_COUNT
    prior = np.hstack([seeds * SEED_SHARE * max(total, 1) + free, free])
    # to begin with, topics differ in their seeds alone
    spread = free / max(free.sum(), 1e-300)
    weights = np.hstack([SEED_START * seeds + (1 - SEED_START) * spread, (1 - SEED_START) * spread])
    shape, context = weights.shape, counted.sparkSession.sparkContext
    for _ in range(rounds):
        shared = context.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch], out: np.ndarray) -> None:
            for batch in parts_of(batches, "buckets", max(ENTRIES // shape[1], 1)):
                row, bucket, tf = _entries(batch)
                _, shares = _mixtures(row, bucket, tf, batch.num_rows, shared.value, INNER_ROUNDS)
                for t in range(shape[1]):
                    out[:, t] += np.bincount(bucket, tf * shares[:, t], shape[0])

        found = linear.summed(counted, shape, run)
        shared.unpersist()
        weights = (found + prior) / (found + prior).sum(axis=0)
    # words of no text and no seed tell nothing
    return GuidedModel(topics, weights * ((found.sum(axis=1) > 0) | (seeds.sum(axis=1) > 0))[:, None], language)


def guided_tags(
    model: GuidedModel, texts: DataFrame, *keep: str, text: str = "text", top: int = 3, least_share: float = 0.1
) -> DataFrame:
    """The ``top`` topics of each text by share of its words, ``(keep, rank, theme, subtheme, share)``.

    Topics below ``least_share`` are not named, nor is the one without seeds; a text without words has none. Nothing is shuffled.
    """
    hashed = linear.hashed_words(F.col(text), model.language, model.weights.shape[0])
    return _tags(model, texts, hashed, None, *keep, top=top, least_share=least_share)


def tags_of_counts(model: GuidedModel, counts: DataFrame, *keep: str, top: int = 3, least_share: float = 0.1) -> DataFrame:
    """``guided_tags`` from ``topic_counts`` of the model's language and number of features."""
    return _tags(model, counts, F.col("buckets"), F.col("tfs"), *keep, top=top, least_share=least_share)


def _tags(model: GuidedModel, rows: DataFrame, hashed: Column, tfs: Column | None, *keep: str, top: int, least_share: float) -> DataFrame:
    """Tags from buckets and their counts, or from all buckets of a text."""
    shared = rows.sparkSession.sparkContext.broadcast(model.weights)
    n_topics = model.weights.shape[1]

    def shares_of(batch: pa.RecordBatch) -> pa.Array:
        found = [np.zeros((0, n_topics))]
        for part in parts_of(iter([batch]), "buckets", max(ENTRIES // n_topics, 1)):
            row, bucket, tf = _entries(part) if "tfs" in part.schema.names else bucket_counts(part.column("buckets"))
            counted, _ = _mixtures(row, bucket, tf, part.num_rows, shared.value, INNER_ROUNDS)
            found.append(counted / np.maximum(np.bincount(row, tf, part.num_rows), 1)[:, None])
        flat = np.concatenate(found)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, flat.size + 1, n_topics, dtype=np.int32)), pa.array(flat.ravel()))

    @F.arrow_udf("array<double>")
    def mixtures(buckets: pa.Array) -> pa.Array:
        return shares_of(pa.RecordBatch.from_arrays([buckets], names=["buckets"]))

    @F.arrow_udf("array<double>")
    def counted_mixtures(buckets: pa.Array, tfs: pa.Array) -> pa.Array:
        return shares_of(pa.RecordBatch.from_arrays([buckets, tfs], names=["buckets", "tfs"]))

    shares = mixtures.asNondeterministic()(hashed) if tfs is None else counted_mixtures.asNondeterministic()(hashed, tfs)
    names = F.array(*[F.struct(F.lit(a).alias("theme"), F.lit(b).alias("subtheme")) for a, b in model.topics])
    entries = F.zip_with(
        F.slice("_shares", 1, len(model.topics)), names,
        lambda s, n: F.struct((-F.round(s, 6)).alias("minus"), n["subtheme"].alias("subtheme"), n["theme"].alias("theme")),
    )
    best = F.slice(F.array_sort(F.filter(entries, lambda e: e["minus"] <= -least_share)), 1, top)
    return (
        rows.select(*keep, shares.alias("_shares"))
        .select(*keep, F.posexplode(best).alias("_rank", "_best"))
        .select(*keep, (F.col("_rank") + 1).alias("rank"), "_best.theme", "_best.subtheme", (-F.col("_best.minus")).alias("share"))
    )


def topic_words(model: GuidedModel, texts: DataFrame, text: str = "text", top: int = 10) -> DataFrame:
    """The ``top`` words of every topic, ``(theme, subtheme, rank, word, weight)``, among the words of ``texts``.

    Buckets get their words back from the texts; of words that share a bucket the more frequent comes first.
    """
    spark, n_features = texts.sparkSession, model.weights.shape[0]
    counted = linear.with_features(texts.select(text), text, model.language, n_features)
    vocabulary = counted.select(F.inline("_words")).groupBy("word").agg(F.sum("tf").alias("n"))
    used = np.argwhere(model.weights[:, : len(model.topics)] > 1 / n_features)
    table = pa.table({
        "bucket": pa.array(used[:, 0], pa.int32()), "topic": pa.array(used[:, 1], pa.int32()),
        "weight": pa.array(model.weights[used[:, 0], used[:, 1]]),
    })
    names = spark.createDataFrame([(n, *t) for n, t in enumerate(model.topics)], "topic INT, theme STRING, subtheme STRING")
    worded = vocabulary.withColumn("bucket", F.pmod(F.xxhash64("word"), F.lit(n_features)).cast("int"))
    found = worded.join(spark.createDataFrame(table), "bucket").join(F.broadcast(names), "topic")  # one row per topic
    best = Window.partitionBy("theme", "subtheme").orderBy(F.desc("weight"), F.desc("n"), "word")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("theme", "subtheme", "rank", "word", F.round("weight", 6).alias("weight"))
