"""Merkle manifest of a table: hash trees per group under one root, with a proof for every row.

All levels are tables of ``(tree, idx, digest)``. At each level every node sends its digest to the
computed indices of its siblings (``idx`` with another slot in the same run of ``arity`` nodes, which
is ``idx XOR 1`` for two) and an equijoin on ``(tree, idx)`` brings them together. The rows of
slot zero then emit the parents: digests of a whole run. Levels shrink by ``arity``; on the way back each
level takes its parents' paths by one equijoin, so paths cost no more than the leaves themselves.

Trees grow by rows, never by group: a group with all rows is spread over as many tasks as any other.

Defined cases: null groups form a tree of their own, which comes first; null ids come before all
others of their group; rows with equal ids go by their digest, and equal rows are equal leaves at
neighbouring places; a single leaf is its tree's root; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newscov.llm.common import stored
from newscov.scale import with_position

ARITY = 8
#: Fields of a leaf, in the order they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def row_digest(*values: Column) -> Column:
    """SHA-256 of the values: ``-`` for null, else UTF-8 byte count, ``:`` and the value."""

    def field(value: Column) -> Column:
        written = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(written).cast("string"), F.lit(":"), written), F.lit("-"))

    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


def _hexed(digests: Column) -> Column:
    return F.array_join(F.transform(digests, lambda d: F.lower(F.hex(d))), "")


def _linked(nodes: DataFrame, arity: int, name: str) -> DataFrame:
    """Nodes with ``siblings``, the ``(slot, digest)`` of the other nodes of their run, by slot.

    The group-by reuses the join's partitioning.
    """
    slot = F.pmod("idx", F.lit(arity))
    sent = nodes.select("tree", "idx", "digest", F.explode(F.array(*map(F.lit, range(1, arity)))).alias("offset"))
    target = F.col("idx") - slot + F.pmod(slot + F.col("offset"), F.lit(arity))
    sent = sent.select(
        F.col("tree"), target.alias("idx"), F.struct(slot.cast("int").alias("slot"), F.col("digest").alias("digest")).alias("sibling")
    )
    met = nodes.join(sent, ["tree", "idx"], "left")
    found = F.sort_array(F.collect_list("sibling"))  # a left join's null is not collected
    own = [F.first(c).alias(c) for c in nodes.columns if c not in ("tree", "idx")]
    return stored(met.groupBy("tree", "idx").agg(*own, found.alias("siblings")), name)


def _parents(linked: DataFrame, arity: int) -> DataFrame:
    """One node per run, emitted by the row of slot zero."""
    run = F.concat(F.array("digest"), F.transform("siblings", lambda s: s["digest"]))
    return linked.where(F.pmod("idx", F.lit(arity)) == 0).select(
        "tree",
        F.expr(f"idx div {arity}").alias("idx"),
        F.unhex(F.sha2(_hexed(run).cast("binary"), 256)).alias("digest"),
        F.expr(f"(width + {arity - 1}) div {arity}").alias("width"),
    )


def _levels(leaves: DataFrame, arity: int, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Linked levels from the leaves up, and the root ``(tree, digest)`` of every tree.

    ``width`` is the number of nodes a node's tree has on its level; trees leave once it is 1.
    """
    levels, tops, nodes = [], [], leaves
    while True:
        tops.append(nodes.where("width = 1").select("tree", "digest"))
        open_nodes = nodes.where("width > 1")
        if open_nodes.isEmpty():
            break
        levels.append(_linked(open_nodes, arity, name))
        nodes = _parents(levels[-1], arity)
    roots = tops[0]
    for top in tops[1:]:
        roots = roots.unionByName(top)
    return levels, roots


def _step(arity: int) -> Column:
    """What a node's siblings contribute on both sides of it, as hex text."""
    own = F.pmod("idx", F.lit(arity))

    def side(keep) -> Column:
        return _hexed(F.transform(F.filter("siblings", keep), lambda s: s["digest"]))

    return F.struct(side(lambda s: s["slot"] < own).alias("before"), side(lambda s: s["slot"] > own).alias("after"))


def _paths(leaves: DataFrame, levels: list[DataFrame], above: DataFrame, arity: int) -> DataFrame:
    """``leaves`` with ``path``: the steps from each to its tree's root, then those of ``above(tree, path)``."""
    down = None  # paths of the nodes of the level above
    for level in reversed(levels):
        tops = level.where(f"width <= {arity}").join(above, "tree")  # children of a root
        if down is not None:
            rest = level.where(f"width > {arity}").withColumn("up", F.expr(f"idx div {arity}"))
            higher = down.select("tree", F.col("idx").alias("up"), "path")
            tops = tops.unionByName(rest.join(higher, ["tree", "up"]).drop("up"))
        down = tops.withColumn("path", F.concat(F.array(_step(arity)), F.col("path")))
    lone = leaves.where("width = 1").join(above, "tree")
    return lone if down is None else lone.unionByName(down.drop("siblings"))


def proofs(leaves: DataFrame, arity: int = ARITY, name: str = "merkle") -> DataFrame:
    """Roots and proofs of ``leaves(group, ident, digest, ...)``; other columns come along.

    ``digest`` is hex. Leaves of a group ascend by ``ident``, then ``digest``; every ``arity`` consecutive
    nodes are hashed to a parent until one is left, the group's ``subroot``. Subroots in the order of
    their groups make one more tree, whose root is ``root``. ``path`` lists from the leaf up what
    stands before and after a node in the run that is hashed next.
    """
    if arity < 2:
        raise ValueError("a parent needs two children at least")
    extra = [c for c in leaves.columns if c not in ("group", "ident", "digest")]
    order = F.struct("group", "ident", "digest", *[F.col(c) for c in extra])
    placed = with_position(leaves, order, name="at")
    groups = placed.groupBy("group").agg(F.min("at").alias("start"), F.count("*").alias("width"))
    own = with_position(groups, "group", name="tree").withColumnRenamed("group", "of")
    nodes = placed.join(own, F.col("group").eqNullSafe(F.col("of"))).select(
        "tree", (F.col("at") - F.col("start")).alias("idx"), F.unhex("digest").alias("digest"), "width", "group", "ident", *extra
    )
    nodes = stored(nodes, f"{name}-nodes")
    levels, subroots = _levels(nodes, arity, name)
    subroots = stored(subroots, f"{name}-subroots")
    tops = subroots.select(
        F.lit(0).alias("tree"), (F.col("tree") - 1).alias("idx"), "digest", F.lit(subroots.count()).cast("long").alias("width")
    )
    top_levels, root = _levels(tops, arity, f"{name}-top")
    start = root.select("tree", F.lit([]).cast("array<struct<before:string,after:string>>").alias("path"))
    over = _paths(tops, top_levels, start, arity).join(
        root.select("tree", F.lower(F.hex("digest")).alias("root")), "tree"
    )
    over = over.select((F.col("idx") + 1).alias("tree"), F.lower(F.hex("digest")).alias("subroot"), "root", "path")
    over = stored(over, f"{name}-over")
    found = _paths(nodes, levels, over.select("tree", "path"), arity)
    found = found.join(over.select("tree", "subroot", "root"), "tree")
    return found.select(
        "group", "ident", *extra, F.lower(F.hex("digest")).alias("digest"), "idx", "subroot", "root", "path"
    )


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings on a path, level by level and left to right."""
    steps = F.transform(path, lambda s: F.concat(s["before"], s["after"]))
    return F.sha2(F.array_join(steps, "").cast("binary"), 256)


def folded(path: Column, digest: Column) -> Column:
    """The root that follows from a leaf and its path."""
    return F.aggregate(path, digest, lambda d, s: F.sha2(F.concat(s["before"], d, s["after"]).cast("binary"), 256))


def tampered(ident: Column, text: Column) -> Column:
    """``text`` with A-Z lower-cased where 3 divides the checksum of the id; unchanged elsewhere."""
    hit = F.crc32(ident.cast("string").cast("binary")) % 3 == 0
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(hit, F.translate(text, upper, upper.lower())).otherwise(text)


def verified_manifest(docs: DataFrame, arity: int = ARITY) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` of every row.

    The manifest is built on the rows as they are; ``folded_root`` folds the leaf of the row after ``tampered``
    with the manifest's siblings. A row whose text has no capitals stays as it is and verifies.
    """
    values = {c: F.col(f"`{c}`") for c in FIELDS}
    after = values | {"text": tampered(values["doc_id"], values["text"])}
    leaves = docs.select(
        values["lang"].alias("group"), values["doc_id"].alias("ident"),
        row_digest(*values.values()).alias("digest"), row_digest(*after.values()).alias("candidate"),
    )
    proved = proofs(stored(leaves, "merkle-digests"), arity)
    return proved.select(
        F.col("ident").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root",
        proof_digest(F.col("path")).alias("proof_sha256"), folded(F.col("path"), F.col("candidate")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
