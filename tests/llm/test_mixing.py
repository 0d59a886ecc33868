import random

import pytest
from pyspark.sql import functions as F

from newscov.llm import mixing as M

WEIGHTS = (5, 2, 1)


def targets(sizes):
    """Shares by weight; what is above three times a size goes round again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(names)}
    total, open_, out = sum(sizes.values()), set(names), {}
    while open_:
        level = total / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > 3 * sizes[s]}
        if not above:
            return out | {s: level * weight[s] for s in open_}
        out |= {s: 3.0 * sizes[s] for s in above}
        total -= sum(3 * sizes[s] for s in above)
        open_ -= above
    return out


def mixed(spark, rows, **more):
    df = spark.createDataFrame([(*r, 1, "p") for r in rows], "doc_id LONG, text STRING, source STRING, place INT, blocks STRING")
    return M.mix(df, **more).cache()


def corpus(seed, sources, n=600):
    rng = random.Random(seed)
    return [(i, " ".join("w" * rng.choice([1, 5, 30, 120])), rng.choice(sources)) for i in range(n)]


@pytest.mark.parametrize("seed,sources", [(0, ["a"] * 6 + ["b", "c", "d"]), (1, ["Z", "a", "é", None]), (2, ["x"] * 40 + list("abcdefgh"))])
def test_targets_and_draws(spark, seed, sources):
    rows = corpus(seed, sources)
    got = mixed(spark, rows, block_words=200, shards=5)
    sizes, source = {}, {i: s for i, _, s in rows}
    for i, text, s in rows:
        sizes[s] = sizes.get(s, 0) + len(text.split())
    expected = targets(sizes)
    taken = {}
    for r in got.collect():
        s = source[r.doc_id]
        assert r.mix.source_size == sizes[s] and r.mix.target == pytest.approx(expected[s])
        assert r.mix.taken == r.mix.size * len(r.mix.draws) <= 3 * r.mix.size
        taken[s] = taken.get(s, 0) + r.mix.taken
    for s, n in expected.items():
        assert abs(taken[s] - n) <= 120
    copies = M.mixture(got)
    assert copies.count() == got.selectExpr("sum(size(mix.draws))").first()[0]
    assert {r.shard for r in copies.select("shard").collect()} <= set(range(5))
    again = M.mixture(mixed(spark, random.Random(5).sample(rows, len(rows)), block_words=200, shards=5))
    assert copies.exceptAll(again).count() == 0 == again.exceptAll(copies).count()


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "  \t\n", "b"), (4, "one\x0btwo\u00a0x", None), (5, "one two", "a"), (5, "one two", "a"), (None, "x y z", "b")]
    got = {(r.doc_id, r.mix.size): r.mix.taken for r in mixed(spark, rows).collect()}
    assert set(got) == {(1, 0), (2, 0), (3, 0), (4, 2), (5, 2), (None, 3)}
    assert got[1, 0] == got[2, 0] == got[3, 0] == 0


def test_tables_without_words(spark):
    assert mixed(spark, []).collect() == []
    (row,) = mixed(spark, [(1, None, "a")]).collect()
    assert (row.mix.target, row.mix.taken) == (0.0, 0)


def test_size_column_and_clashing_names(spark):
    df = spark.createDataFrame([(1, "a", 4, 0), (2, "b", 4, 0)], "doc_id LONG, source STRING, size LONG, shard INT")
    got = M.mix(df, size_column="size")
    assert got.columns == ["doc_id", "source", "size", "shard", "mix"]
    assert M.mixture(got).columns == ["doc_id", "source", "size", "shard", "position"]


def exact(good, total, draws):
    from math import comb

    return [comb(good, k) * comb(total - good, draws - k) / comb(total, draws) for k in range(min(good, draws) + 1)]


@pytest.mark.parametrize("good,total,draws", [(3, 10, 4), (50, 120, 60), (0, 9, 3), (9, 9, 3), (5, 5, 5), (7, 20, 0), (400, 1000, 500)])
def test_hypergeometric_quantiles(spark, good, total, draws):
    us = [0.0, 0.01, 0.2, 0.5, 0.8, 0.99, 0.999999]
    df = spark.createDataFrame([(u, good, total, draws) for u in us], "u DOUBLE, g LONG, t LONG, d LONG")
    got = [r[0] for r in df.select(M._hypergeometric(F.col("u"), F.col("g"), F.col("t"), F.col("d"))).collect()]
    chances = exact(good, total, draws)
    for u, k in zip(us, got):
        assert 0 <= k < len(chances) and draws - k <= total - good
        assert sum(chances[:k]) <= u + 1e-9 and (u < sum(chances[: k + 1]) + 1e-9)


def test_tree_loses_and_doubles_no_block(spark):
    quotas = spark.createDataFrame([(0, 101), (1, 7), (2, 0), (3, 1)], "place INT, quota LONG")
    rows = M.split_quotas(quotas, 7).collect()
    for place, quota in ((0, 101), (1, 7), (2, 0), (3, 1)):
        own = sorted((r.shard, r.start, r.quota) for r in rows if r.place == place)
        assert sum(q for *_, q in own) == quota and all(q >= 0 for *_, q in own)
        at = 0
        for _, start, q in own:
            assert start == at
            at += q
    per_shard = [sum(r.quota for r in rows if r.shard == s) for s in range(7)]
    assert max(per_shard) - min(per_shard) <= 2
