"""Shards that all hold the corpus mixture: proportional stratified interleaving.

Every source is shuffled by a seeded hash and ranked. A row's fractional rank, ``(rank - 1/2) /
rows of its source``, says how far through its source it lies; sorting all rows by it deals the
sources out evenly, so that any run of neighbours holds them in the corpus's own proportions.
The sorted rows are then cut into runs whose lengths differ by one row at most.

Ranks are positions in a range sort less the position at which the source begins, so a source
with a third of all rows is ranked by as many tasks as its rows need. What is sorted are keys;
texts stay where they are.

Defined cases: a null source is a source of its own; null ids are shuffled like any other
(hashed as an empty string); rows that agree in id, size, checksum and source may
trade places, which changes nothing in the result; an empty table gives no rows; a null text
has no bytes and size 1.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newscov.llm.common import numbered, stored
from newscov.scale import with_position

SHARDS = 16
SEED = 20240607
#: Each shard holds as many rows as any other, or one more.
LAW = "rows"


def shuffle_key(ident: Column, seed: int = SEED) -> Column:
    """60 bits that order the rows of a source at random, the same on every run."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def interleaved(rows: DataFrame, source: str = "source", ident: str = "doc_id", seed: int = SEED) -> DataFrame:
    """``rows`` with ``place``, their number from 0 in the mixed order, and ``total``, the number of all rows.

    All columns travel through two range sorts: pass keys and what is small. Columns must not
    be called ``place``, ``total``, ``position`` or begin with an underscore.
    """
    hashed = rows.withColumn("_key", shuffle_key(F.col(ident), seed))
    rest = [F.col(c) for c in rows.columns if c not in (source, ident)]
    ranked = with_position(hashed, F.struct(F.col(source), F.col("_key"), F.col(ident), *rest), name="_at")
    strata = ranked.groupBy(F.col(source).alias("_stratum")).agg(
        F.min("_at").alias("_first"), F.count("*").alias("_rows")
    )
    mixed = ranked.join(strata, F.col(source).eqNullSafe(F.col("_stratum")))
    # both numbers are exact in a double up to 2**52 rows
    fraction = (F.col("_at") - F.col("_first") + 0.5) / F.col("_rows")
    mixed = mixed.select(*rows.columns, "_key", fraction.alias("_fraction"))
    order = F.struct(F.col("_fraction"), F.col("_key"), F.col(source), F.col(ident), *rest)
    placed = with_position(mixed, order, name="place").withColumn("place", F.col("place") - 1)
    total = strata.agg(F.sum("_rows")).scalar()
    return placed.withColumn("total", total).drop("_key", "_fraction")


def cut(place: Column, total: Column, shards: int = SHARDS) -> tuple[Column, Column]:
    """Shard and slot of a place: run ``k`` begins at the first place not below ``k * total / shards``."""
    # the quotient and remainder are taken apart, so that no product overflows
    whole, part = F.call_function("div", total, F.lit(shards)), F.pmod(total, F.lit(shards))

    def start(k: Column) -> Column:
        return k * whole + F.ceil(k * part / shards)

    near = F.greatest(F.least(F.floor(place / total * shards), F.lit(shards - 1)), F.lit(0)).cast("long")
    # the double quotient can be off by one run either way at a border
    exact = F.when(place < start(near), near - 1).when(place >= start(near + 1), near + 1).otherwise(near)
    return exact.cast("int"), (place - start(exact)).cast("long")


def sharded(
    docs: DataFrame, shards: int = SHARDS, ident: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED
) -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)`` of every row.

    ``size`` is the text's UTF-8 bytes and one more. ``grown_shard`` is null: the law is
    ``rows``, under which another number of shards moves rows between all of them.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    keys = docs.select(
        F.col(f"`{ident}`").alias("doc_id"),
        F.col(f"`{source}`").alias("source"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    placed = interleaved(stored(keys, "shard-keys"), seed=seed)
    shard, slot = cut(F.col("place"), F.col("total"), shards)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), shard.alias("shard"), slot.alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(
    docs: DataFrame, folder: str, shards: int = SHARDS, ident: str = "doc_id", source: str = "source", seed: int = SEED
) -> None:
    """Write ``docs`` to ``folder/shard=k``, each shard's rows in the order of their slots.

    Files of a shard hold consecutive slots, in the order of their names. Ranges of slots, not whole shards,
    go to one task, as shards grow with the corpus.
    """
    kept = numbered(docs.withColumnsRenamed({c: f"c{i}" for i, c in enumerate(docs.columns)}), "shard-rows")
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    keys = kept.select(F.col(names[ident]).alias("doc_id"), F.col(names[source]).alias("source"), "node")
    placed = interleaved(keys, seed=seed)
    shard, slot = cut(F.col("place"), F.col("total"), shards)
    placed = placed.select("node", shard.alias("shard"), slot.alias("slot"))
    dealt = kept.join(placed, "node").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    columns = [F.col(n).alias(c) for c, n in names.items() if c not in ("shard", "slot")]
    dealt.select(*columns, "slot", "shard").write.partitionBy("shard").parquet(folder)
