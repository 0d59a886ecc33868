import math

import numpy as np
import pytest

from newscov.llm import embedding_dedup as E

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, label INT, key STRING, rep LONG"


def expected(rows, threshold):
    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, np.float32).astype(np.float64)
        return v / np.linalg.norm(v)

    units = [None if r[0] is None else unit(r[1]) for r in rows]
    n = len(rows)
    links = [
        {j for j in range(n) if j != i and units[i] is not None and units[j] is not None
         and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold}
        for i in range(n)
    ]
    out = []
    for i, (ident, _) in enumerate(rows):
        seen, stack = {i}, [i]
        while stack:
            stack += (new := links[stack.pop()] - seen)
            seen |= new
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((ident, len(links[i]), least, ident == least))
    return sorted(out, key=repr)


def found(spark, rows, threshold=0.9, **more):
    df = spark.createDataFrame([(*r, 0, "x", 9) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in E.near_vectors(df, threshold, **more).collect()), key=repr)


def chains(seed, n=60, dim=8):
    """Groups of copies and near copies, chains included."""
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        v = rng.normal(size=dim)
        for _ in range(rng.integers(1, 4)):
            rows.append((len(rows), [float(x) for x in v.astype(np.float32)]))
            v = v + rng.normal(size=dim) * rng.choice([0, 0.05, 0.3])
    return rows


@pytest.mark.parametrize("seed,tile", [(0, 4096), (1, 16), (2, 5)])
def test_equals_brute_force(spark, seed, tile):
    rows = chains(seed)
    assert found(spark, rows, tile=tile) == expected(rows, 0.9)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]),
        (8, [1.0, None]), (9, [1.0, 0.0, 0.0]), (2, [1.0, 1e-6]), (None, [1.0, 0.0]), (10, [-0.0, 3.0]), (11, [0.0, 3.0]),
        (12, [1e30, 0.0]),
    ]
    got = found(spark, rows)
    assert got == expected(rows, 0.9)
    assert (1, 3, 1, True) in got and (None, 0, None, True) in got


def test_empty_table(spark):
    assert found(spark, []) == []


def test_doubles_and_exact_threshold(spark):
    df = spark.createDataFrame([(1, [0.6, 0.8]), (2, [1.0, 0.0]), (3, [0.0, 1.0])], "vec_id LONG, embedding ARRAY<DOUBLE>")
    assert sorted(tuple(r)[:2] for r in E.near_vectors(df, 0.8).collect()) == [(1, 1), (2, 0), (3, 1)]


def test_bound_is_rigorous():
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(200, 2100)).astype("<f4")  # longer than one exact run
    row = {"tile": 1, "ids": np.arange(200).tobytes(), "copies": np.ones(200, np.int64).tobytes(), "vectors": vectors.tobytes()}
    q = E._Quantised(row, "<f4")
    products = E._code_products(q.exact, q.exact) * q.scale[:, None] * q.scale[None, :]
    bound = q.error[:, None] * q.length + q.length[:, None] * q.error + q.error[:, None] * q.error
    assert (np.abs(products - q.unit @ q.unit.T) <= bound + 1e-12).all()


def test_bad_threshold(spark):
    with pytest.raises(ValueError):
        E.near_vectors(spark.createDataFrame([], SCHEMA), 0.0)
