"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newscov.llm.common import stored

#: Weights the sources get in turn, in code point order of their names, null last.
WEIGHTS = (5, 2, 1)
#: No source, and so no document, is drawn more often than this.
MOST_REPEATS = 3
#: Words that a block holds on average, and blocks that a group of blocks holds.
BLOCK_WORDS = 16_384
GROUP_BLOCKS = 1_024
SEED = 11


def word_count(text: Column) -> Column:
    """Runs of characters that are not ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) that only depends on ``parts``."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(float(1 << 53))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``: shares of all words by weight.

    Sources whose share exceeds ``most`` times their size stop there, and what they leave is
    shared by weight among the others until none is above. In order of size per weight the
    stopped sources come first, so one running sum finds them all. The table has a row per source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    sized = sizes.withColumn("place", F.row_number().over(by_name) - 1)
    sized = sized.withColumn("weight", F.get(turn, F.col("place") % len(weights)))
    sized = sized.withColumn("cap", F.col("source_size") * most)
    order = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    weight_left = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    ranked = sized.withColumn("level", left / weight_left)
    ranked = ranked.withColumn("stopped", F.col("level") * F.col("weight") > F.col("cap"))
    level = F.min(F.when(~F.col("stopped"), F.struct("cap_rank", "level"))).over(everything)["level"]
    ranked = ranked.withColumn("cap_rank", F.row_number().over(order)).withColumn("final", level)
    target = F.when(F.col("stopped"), F.col("cap").cast("double")).otherwise(F.col("final") * F.col("weight"))
    return ranked.select("source", "place", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def _hypergeometric(u: Column, good: Column, total: Column, draws: Column) -> Column:
    """How many of ``good`` among ``total`` items are in ``draws``, at quantile ``u``.

    Weights of neighbouring counts follow from each other, so they are taken relative to the
    mode's. Counts beyond 12 deviations and 12 from the mode, which weigh under 1e-30, are left out.
    """
    low = F.greatest(F.lit(0), draws - (total - good)).cast("long")
    high = F.least(good, draws).cast("long")
    mode = F.floor((draws + 1) * (good + 1) / (total + 2)).cast("long")
    mode = F.least(F.greatest(mode, low), high)
    some = F.greatest(total, F.lit(2)).cast("double")
    spread = good / some * (total - good) / some * draws * (total - draws) / (some - 1)
    reach = F.ceil(F.sqrt(spread) * 12 + 12).cast("long")
    first, last = F.greatest(low, mode - reach), F.least(high, mode + reach)

    def up(k: Column) -> Column:  # weight of k + 1 over that of k
        return (good - k) * (draws - k) / ((k + 1.0) * (total - good - draws + k + 1))

    empty = F.array().cast("array<double>")
    start = F.struct(F.lit(1.0).alias("w"), empty.alias("all"))

    def climb(state: Column, k: Column) -> Column:
        w = state["w"] * up(k)
        return F.struct(w.alias("w"), F.concat(state["all"], F.array(w)).alias("all"))

    def descend(state: Column, k: Column) -> Column:
        w = state["w"] / up(k)
        return F.struct(w.alias("w"), F.concat(state["all"], F.array(w)).alias("all"))

    none = F.array().cast("array<bigint>")
    above = F.aggregate(F.when(last > mode, F.sequence(mode, last - 1)).otherwise(none), start, climb)["all"]
    below = F.aggregate(F.when(first < mode, F.sequence(mode - 1, first, F.lit(-1))).otherwise(none), start, descend)["all"]
    weights = F.concat(F.reverse(below), F.array(F.lit(1.0)), above)
    whole = F.aggregate(weights, F.lit(0.0), lambda a, w: a + w)
    walk = F.aggregate(
        weights,
        F.struct(F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("n")),
        lambda s, w: F.struct(
            (s["sum"] + w).alias("sum"), (s["n"] + F.when(s["sum"] + w <= u * whole, 1).otherwise(0)).alias("n")
        ),
    )
    return F.least(first + walk["n"], last)


def split_quotas(quotas: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """``(source, shard, quota, start)``: blocks of each source for each output shard.

    Starts with one node that holds every source's blocks and all shards, and halves it until
    each node is one shard. The left half's number of blocks is its part of the node's, and its
    share of each source is drawn one source after the other, given the sources before: a
    multivariate hypergeometric draw, so no block is lost or doubled. A node is one row with one
    number per source; ``start`` is where the shard's blocks of a source begin.
    """
    nodes = quotas.groupBy().agg(
        F.array_sort(F.collect_list(F.struct("place", "quota"))).alias("sources"),
    ).select(
        F.lit(0).alias("first"), F.lit(shards).alias("n"), F.col("sources.place").alias("places"),
        F.col("sources.quota").alias("held"),
    )

    def half(held: Column) -> Column:
        blocks = F.aggregate(held, F.lit(0).cast("long"), lambda a, q: a + q)
        wanted = F.round(blocks * F.floor(F.col("n") / 2) / F.col("n")).cast("long")
        begin = F.struct(
            wanted.alias("wanted"), blocks.alias("total"), F.array().cast("array<bigint>").alias("left")
        )

        def draw(state: Column, quota: Column) -> Column:
            u = uniform(F.lit(seed), F.col("first"), F.col("n"), F.size(state["left"]))
            got = _hypergeometric(u, quota, state["total"], state["wanted"])
            return F.struct(
                (state["wanted"] - got).alias("wanted"),
                (state["total"] - quota).alias("total"),
                F.concat(state["left"], F.array(got)).alias("left"),
            )

        return F.aggregate(held, begin, draw)["left"]

    width = shards
    while width > 1:
        split = stored(nodes.where("n > 1").withColumn("left", half(F.col("held"))), "mix-tree")
        left_n = F.floor(F.col("n") / 2).cast("int")
        lefts = split.select("first", left_n.alias("n"), "places", F.col("left").alias("held"))
        rights = split.select(
            (F.col("first") + left_n).alias("first"), (F.col("n") - left_n).alias("n"), "places",
            F.zip_with("held", "left", lambda a, b: a - b).alias("held"),
        )
        nodes = nodes.where("n = 1").unionByName(lefts).unionByName(rights)
        width = (width + 1) // 2
    leaves = nodes.select(F.col("first").alias("shard"), F.explode(F.arrays_zip("places", "held")).alias("q"))
    leaves = leaves.select("shard", F.col("q.places").alias("place"), F.col("q.held").alias("quota"))
    before = Window.partitionBy("place").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return leaves.withColumn("start", F.coalesce(F.sum("quota").over(before), F.lit(0)))


def mix(
    docs: DataFrame,
    shards: int = 16,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    size_column: str | None = None,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """Every row with its ``mix``: ``size, source_size, target, taken`` and its ``draws``.

    A source's documents are dealt into blocks of about ``block_words`` by a hash, and the number
    of a block is its place in the source's random order. A source gives whole passes over its
    blocks and then blocks from the start until its target is reached; of the last block it gives
    the documents that fit, in hash order, and one that fills the gap best. The tree deals these block draws out to the output shards; a shard's blocks
    are a stretch of that order no other shard has. ``draws`` holds ``(shard, position)`` for
    every copy, where position is a random number to sort the shard by. ``taken`` is size times copies.

    ``size_column`` names a column that already holds ``word_count`` of the text. Null texts have
    size 0. Null sources form one source, the last. A table without words has targets 0. Repeated
    rows are separate documents that are drawn alike. An empty table gives an empty result; the
    one new column, ``mix``, replaces one of that name, and other columns may have any name.

    Blocks are summed before any running sum, and running sums go over the blocks of a group, then
    over groups, so no task sees all rows of a source.
    """
    size = F.col(f"`{size_column}`") if size_column else word_count(F.col(f"`{text_column}`"))
    own = F.struct(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{source_column}`").alias("source"), size.alias("size")
    )
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "mix"]
    marked = docs.select(F.struct(*kept).alias("_row"), own.alias("mix"))
    marked = marked.withColumn("mix", F.col("mix").withField("u", uniform(F.lit(seed), F.col("mix.id"), F.col("mix.size"))))
    meta = stored(marked.select("mix.source", "mix.size", "mix.u"), "mix-sizes")

    totals = meta.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(stored(totals, "mix-sources"))
    n_blocks = F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumns({"n_blocks": n_blocks, "passes": passes.cast("long")})
    targets = stored(targets.withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")), "mix-targets")

    def with_block(rows: DataFrame, source: Column, u: Column) -> DataFrame:
        """Rows joined with their source's row; there is one per source, so Catalyst may broadcast it."""
        placed = rows.join(targets.withColumnRenamed("source", "_source"), source.eqNullSafe(F.col("_source")))
        return placed.withColumn("_block", F.least(F.floor(u * F.col("n_blocks")), F.col("n_blocks") - 1))

    dealt = with_block(meta, F.col("source"), F.col("u"))
    sums = dealt.groupBy("place", "_block").agg(F.sum("size").alias("words"))
    sums = stored(sums.withColumn("group", F.floor(F.col("_block") / GROUP_BLOCKS)), "mix-blocks")
    groups = sums.groupBy("place", "group").agg(F.sum("words").alias("words"), F.count("*").alias("n"))
    earlier = Window.partitionBy("place").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select(
        "place", "group", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("words_before"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("blocks_before"),
        F.sum("n").over(Window.partitionBy("place")).alias("n"),
    )
    inside = Window.partitionBy("place", "group").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = sums.withColumn("before", F.coalesce(F.sum("words").over(inside), F.lit(0)))
    blocks = blocks.withColumn("nth", F.count("*").over(inside)).join(groups, ["place", "group"])
    blocks = blocks.withColumn("before", F.col("before") + F.col("words_before"))
    blocks = blocks.withColumn("nth", F.col("nth") + F.col("blocks_before"))
    blocks = blocks.join(targets.select("place", "passes", "rest"), "place")
    blocks = blocks.withColumn("cut", F.col("before") < F.col("rest"))
    blocks = blocks.withColumn("edge", F.col("cut") & (F.col("before") + F.col("words") > F.col("rest")))
    blocks = stored(blocks, "mix-order")

    # of the one block per source that the target ends in: documents up to a hash value, and one more
    # that fills the gap best, if any makes it smaller
    edges = blocks.where("edge").select("place", "_block", "before", "rest")
    order = Window.partitionBy("place").orderBy("u").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    inner = dealt.select("place", "_block", "u", "size").join(edges, ["place", "_block"])
    inner = stored(inner.withColumn("reach", F.col("before") + F.sum("size").over(order)), "mix-edges")
    fits = inner.where("reach <= rest").groupBy("place").agg(F.max("u").alias("last_u"), F.max("reach").alias("full"))
    later = inner.join(fits, "place", "left").where("last_u IS NULL OR u > last_u")
    later = later.withColumn("gap", F.col("rest") - F.coalesce("full", "before"))
    miss = F.abs(F.col("gap") - F.col("size"))
    filler = later.where(miss < F.col("gap")).groupBy("place").agg(F.min(F.struct(miss, "u"))["u"].alias("extra_u"))
    last = edges.select("place").join(fits.drop("full"), "place", "left").join(filler, "place", "left")

    quotas = blocks.groupBy("place").agg(F.sum(F.col("passes") + F.col("cut").cast("long")).alias("quota"))
    deals = split_quotas(quotas, shards, seed).where("quota > 0")
    numbered = deals.select(
        "place", "shard", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("quota") - 1)).alias("draw")
    )
    turn = F.col("passes") + F.col("cut").cast("long") - 1
    drawn = blocks.join(last, "place", "left").where(turn >= 0).withColumn("pass", F.explode(F.sequence(F.lit(0), turn)))
    whole = F.when((F.col("pass") < F.col("passes")) | ~F.col("edge"), 1.0).otherwise(F.coalesce("last_u", F.lit(-1.0)))
    drawn = drawn.select(
        "place", "_block", (F.col("pass") * F.col("n") + F.col("nth")).alias("draw"), whole.alias("up_to"),
        F.coalesce("extra_u", F.lit(-1.0)).alias("extra"),
    )
    # at most as many entries as a document may be repeated
    drawn = drawn.join(numbered, ["place", "draw"]).groupBy("place", "_block")
    drawn = stored(drawn.agg(F.array_sort(F.collect_list(F.struct("draw", "shard", "up_to", "extra"))).alias("_draws")), "mix-draws")

    rows = with_block(marked, F.col("mix.source"), F.col("mix.u")).join(drawn, ["place", "_block"], "left")
    none = F.array().cast(drawn.schema["_draws"].dataType)
    u = F.col("mix.u")
    draws = F.filter(F.coalesce("_draws", none), lambda d: (u <= d["up_to"]) | (u == d["extra"]))
    draws = F.transform(
        draws,
        lambda d: F.struct(d["shard"].alias("shard"), uniform(F.lit(seed), F.col("mix.id"), d["draw"]).alias("position")),
    )
    result = F.struct(
        F.col("mix.size").alias("size"), "source_size", "target", (F.size("_kept") * F.col("mix.size")).alias("taken"),
        F.col("_kept").alias("draws"),
    )
    return rows.withColumn("_kept", draws).select("_row.*", result.alias("mix"))


def mixture(mixed: DataFrame) -> DataFrame:
    """One row per copy, with ``shard`` and ``position``; each shard sorted by position is the mix."""
    kept = [F.col(f"`{c}`") for c in mixed.columns if c not in ("mix", "shard", "position")]
    return mixed.select(*kept, F.explode("mix.draws").alias("_draw")).select(*kept, "_draw.shard", "_draw.position")
