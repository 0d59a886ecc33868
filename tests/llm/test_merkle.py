import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from newscov.llm import merkle as M

SCHEMA = "doc_id LONG, source STRING, lang STRING, n_chars LONG, text STRING, tree INT, idx STRING, root STRING"


def docs(spark, rows):
    return spark.createDataFrame([(*r, 3, "x", "y") for r in rows], SCHEMA)


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def lowered(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def climb(nodes, arity):
    """Root and, per leaf, its steps (before, after)."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for n, i in enumerate(at):
            run = i // arity * arity
            steps[n].append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + arity])))
        nodes = [h("".join(nodes[i : i + arity])) for i in range(0, len(nodes), arity)]
        at = [i // arity for i in at]
    return nodes[0], steps


def expected(rows, arity):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = []
    for group in order:
        own = sorted(groups[group], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((own, *climb([leaf(r) for r in own], arity)))
    if not trees:
        return []
    root, over = climb([t[1] for t in trees], arity)
    out = []
    for (own, subroot, steps), above in zip(trees, over):
        for row, path in zip(own, steps):
            path = path + above
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0
            state = leaf((*row[:4], lowered(row[4]))) if hit else leaf(row)
            for before, after in path:
                state = h(before + state + after)
            proof = h("".join(b + a for b, a in path))
            out.append((row[0], leaf(row), subroot, root, proof, state, state == root))
    return sorted(out, key=repr)


def found(spark, rows, arity=8):
    return sorted((tuple(r) for r in M.verified_manifest(docs(spark, rows), arity).collect()), key=repr)


def corpus(n, langs):
    return [(i * 3 % 101 if i < 90 else i, f"s{i % 5}", langs[i % len(langs)], i, f"Text {i} É") for i in range(n)]


@pytest.mark.parametrize("arity,n", [(8, 200), (2, 61), (3, 82), (8, 9), (8, 64)])
def test_equals_brute_force(spark, arity, n):
    rows = corpus(n, ["en", "en", "en", None, "fr"])
    assert found(spark, rows, arity) == expected(rows, arity)


def test_many_groups_make_a_tree_of_their_own(spark):
    rows = [(i, "s", f"lang{i % 70}", 1, "A") for i in range(150)]
    assert found(spark, rows) == expected(rows, 8)


def test_odd_rows(spark):
    rows = [
        (None, None, None, None, None), (None, "a", None, 1, "B"), (3, "a", "", 0, ""), (3, "a", "", 0, ""), (3, "a", "", 0, "Z"),
        (-5, "é", "fr", None, "Ünï 😀" * 3000), (7, None, "fr", 2, None),
    ]
    assert found(spark, rows) == expected(rows, 8)
    assert found(spark, rows, 2) == expected(rows, 2)
    assert found(spark, []) == []
    assert found(spark, rows[:1]) == expected(rows[:1], 8)


def test_tampering_is_found(spark):
    rows = corpus(60, ["en"])
    for ident, *_, verified in found(spark, rows):
        assert verified == (zlib.crc32(str(ident).encode()) % 3 != 0)


def test_general_proofs_keep_columns(spark):
    leaves = spark.range(20).select(
        (F.col("id") % 2).alias("group"), F.col("id").alias("ident"), F.sha2(F.col("id").cast("string"), 256).alias("digest"),
        (F.col("id") * 2).alias("note"),
    )
    proved = M.proofs(leaves, 4).withColumn("again", M.folded(F.col("path"), F.col("digest")))
    rows = proved.collect()
    assert len(rows) == 20 and all(r["again"] == r["root"] and r["note"] == 2 * r["ident"] for r in rows)
    with pytest.raises(ValueError):
        M.proofs(leaves, 1)


def test_one_exchange_per_side(spark):
    nodes = spark.range(100).selectExpr("0 AS tree", "id AS idx", "CAST('x' AS BINARY) AS digest", "100L AS width")
    slots = M._linked(nodes, 8, "test-linked")
    assert slots.where(F.size("siblings") == 7).count() == 96 and slots.where(F.size("siblings") == 3).count() == 4
