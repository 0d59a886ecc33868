"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newscov.llm import stages
from newscov.llm.common import stored, table

STAGES = [
    ("quality classifier", stages.good_documents),
    ("n-gram Jaccard join", stages.distinct_documents),
    ("suffix-array dedup", stages.unrepeated_texts),
    ("mixing sources to target weights", stages.mixed_documents),
    ("best-fit packing", stages.packed_pieces),
]

#: A fitted model, random draws and token ids cannot be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
