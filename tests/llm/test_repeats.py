import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newscov.llm import repeats as R


def expected(texts, length):
    data = [(t or "").encode() for t in texts]
    count = {}
    for b in data:
        for i in range(len(b) - length + 1):
            count[b[i : i + length]] = count.get(b[i : i + length], 0) + 1
    out = []
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(b), int(gone.sum()), spans, kept, kept.decode("utf-8", "ignore")))
    return out


def found(spark, rows, **more):
    df = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id LONG, text STRING, sh STRING, hot INT")
    got = R.remove_repeats(df, **more)
    assert got.columns == ["doc_id", "sh", "hot", "repeats"]
    return sorted(((r.doc_id, tuple(r.repeats)) for r in got.collect()), key=repr)


def corpus(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared = [text(rng.choice([150, 199, 200, 201, 350, 900])) for _ in range(6)]
    rows = []
    for i in range(50):
        parts = [rng.choice([text(rng.randrange(400)), rng.choice(shared), rng.choice(shared)[: rng.randrange(150, 400)]]) for _ in range(3)]
        rows.append((i, "".join(parts)))
    return rows + [(50, "ab" * 500), (51, "x" * 1000), (52, "ab" * 90), (53, shared[-1]), (54, shared[-1])]


@pytest.mark.parametrize("seed,most", [(0, R.MOST_SEGMENTS), (1, R.MOST_SEGMENTS), (2, 2)])
def test_equals_brute_force(spark, seed, most):
    rows = corpus(seed)
    got = found(spark, rows, most_segments=most)
    assert got == sorted(zip([i for i, _ in rows], expected([t for _, t in rows], 200)), key=repr)
    assert sum(r[1][1] for r in got) > 1000


def test_odd_rows(spark):
    long = "lorem ipsum " * 17
    same = "".join(chr(97 + i * 7 % 26) + str(i) for i in range(100))
    rows = [(1, None), (2, ""), (3, "é" * 99), (4, same), (4, same), (None, same + "!"), (5, long), (4, "other " + same[:150])]
    got = found(spark, rows)
    assert got == sorted(zip([i for i, _ in rows], expected([t for _, t in rows], 200)), key=repr)


def test_empty_table(spark):
    assert found(spark, []) == []


@given(st.lists(st.binary(max_size=60).map(lambda b: bytes(x % 3 + 97 for x in b)), min_size=2, max_size=12), st.integers(0, 8))
@settings(max_examples=200, deadline=None)
def test_deep_shallow_order(strings, shallow):
    order, common = R.sorted_suffixes(strings, shallow)
    assert [strings[i] for i in order] == sorted(strings)
    for k in range(1, len(order)):
        a, b = strings[order[k - 1]], strings[order[k]]
        shared = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert common[k] == shared


@given(st.lists(st.text("ab", max_size=400), min_size=1, max_size=4))
@settings(max_examples=50, deadline=None)
def test_segments_cover_each_window_once(texts):
    data = [t.encode() for t in texts]
    of, first, last, anchor, _ = R.segments(data)
    seen = [(int(t), w) for t, a, b in zip(of, first, last) for w in range(a, b + 1)]
    assert sorted(seen) == [(i, w) for i, t in enumerate(data) for w in range(len(t) - R.LENGTH + 1)]
    assert ((anchor >= last) & (anchor <= first + R.LENGTH - R.ANCHOR)).all()
