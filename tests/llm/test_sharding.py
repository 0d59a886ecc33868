import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from newscov.llm import sharding as S

SCHEMA = "doc_id LONG, text STRING, source STRING, shard STRING, place INT, total INT, size STRING"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", 7, 7, "y") for i, t, s in rows], SCHEMA)


def expected(rows, shards, seed=S.SEED):
    import hashlib

    def key(ident):
        text = f"{seed}:{'' if ident is None else ident}"
        return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)

    def nulls_first(value):
        return (value is not None, value if value is not None else 0)

    keyed = []
    for ident, text, source in rows:
        raw = (text or "").encode()
        keyed.append((source, key(ident), ident, len(raw) + 1, zlib.crc32(raw)))
    by_source = {}
    for row in keyed:
        by_source.setdefault(row[0], []).append(row)
    mixed = []
    for part in by_source.values():
        part.sort(key=lambda r: (r[1], nulls_first(r[2]), r[3], r[4]))
        mixed += [((rank + 0.5) / len(part), row) for rank, row in enumerate(part)]
    mixed.sort(key=lambda m: (m[0], m[1][1], (m[1][0] is not None, (m[1][0] or "").encode()), nulls_first(m[1][2]), m[1][3:]))
    out, starts = [], {}
    for place, (_, row) in enumerate(mixed):
        shard = place * shards // len(mixed)
        out.append((row[2], row[3], row[4], "rows", shard, place - starts.setdefault(shard, place), None))
    return sorted(out, key=repr)


def found(spark, rows, shards=16, **more):
    return sorted((tuple(r) for r in S.sharded(docs(spark, rows), shards, **more).collect()), key=repr)


def corpus(n=700):
    return [(i, f"text {i % 50} é" * (i % 4), None if i % 10 == 0 else "hot" if i % 3 else f"s{i % 7}") for i in range(n)]


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_equals_brute_force(spark, shards):
    assert found(spark, corpus(), shards) == expected(corpus(), shards)


def test_law_slots_and_mixture(spark):
    rows = S.sharded(docs(spark, corpus(1003))).collect()
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) == set(range(16)) and max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(n))
    source = {i: s for i, _, s in corpus(1003)}
    total = Counter(source.values())
    for shard in counts:
        held = Counter(source[r["doc_id"]] for r in rows if r["shard"] == shard)
        # a source's own rounding, and that of the others by its share
        assert all(abs(held[s] - n / 16) <= 1 + len(total) * n / 1003 for s, n in total.items())


def test_odd_rows(spark):
    rows = [(None, None, None), (None, "", "a"), (1, "x", "a"), (1, "x", "a"), (1, "y", "a"), (2, "é" * 5000, "b"), (3, None, "b")]
    assert found(spark, rows) == expected(rows, 16)
    assert found(spark, rows, 2) == expected(rows, 2)
    assert found(spark, []) == []
    with pytest.raises(ValueError):
        S.sharded(docs(spark, rows), 0)


def test_seed_changes_the_order(spark):
    first, again, other = found(spark, corpus()), found(spark, corpus()), found(spark, corpus(), seed=1)
    assert first == again != other


def test_cuts_are_exact_for_huge_tables(spark):
    total = 10**13 + 7
    places = [p for k in range(17) for b in [-(-k * total // 16)] for p in (b - 1, b, b + 1) if 0 <= p < total]
    df = spark.createDataFrame([(p, total) for p in places], "place LONG, total LONG")
    shard, slot = S.cut(F.col("place"), F.col("total"), 16)
    for r in df.select("place", shard.alias("shard"), slot.alias("slot")).collect():
        k = r["place"] * 16 // total
        assert (r["shard"], r["slot"]) == (k, r["place"] - -(-k * total // 16))


def test_written_shards(spark, tmp_path):
    rows = corpus(300)
    S.write_shards(docs(spark, rows), str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    got = sorted((r["doc_id"], r["shard"], r["slot"]) for r in back.collect())
    assert got == sorted((r[0], r[4], r[5]) for r in expected(rows, 4))
    assert dict(back.select("doc_id", "text").collect()) == {i: t for i, t, _ in rows}
