import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newscov.llm import fingerprints as P


def found(spark, rows, **patched):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id LONG, text STRING, fingerprint STRING, range INT")
    return P.fingerprints(df).collect()


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghé") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_edits_and_likeness(spark, monkeypatch):
    monkeypatch.setattr(P, "TASK_BYTES", 4_000)  # several ranges
    rng = random.Random(1)
    rows = [(i * 3, prose(rng, rng.choice([1, 8, 60, 300, 3000]))) for i in range(40)]
    rows += [(200, rows[5][1]), (201, rows[5][1])]
    rng.shuffle(rows)
    got = {r.doc_id: r for r in found(spark, rows)}
    order = sorted(rows)
    for k, (ident, text) in enumerate(order):
        then, half, r = order[(k + 1) % len(order)][1], len(text) // 2, got[ident]
        edited = text[: len(text) - half] + then[:half]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        if half > 4 and text != then:
            assert r.near_edited > r.near_next
    assert got[200].fingerprint == got[201].fingerprint == got[15].fingerprint
    assert got[200].near_next == 1.0


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a"), (4, "x" * 5000), (4, "y"), (None, "first"), (5, "été"), (5, "été")]
    got = {(r.doc_id, r.n_chars): r for r in found(spark, rows)}
    assert len(got) == 7
    assert got[1, 0].fingerprint == got[2, 0].fingerprint and got[1, 0].near_next == 1.0
    assert got[2, 0].near_next == 0.0


def test_single_and_no_row(spark):
    assert found(spark, []) == []
    (row,) = found(spark, [(7, "the only text there is " * 9)])
    assert row.near_next == 1.0


def slow_level(window):
    counts = np.bincount(np.frombuffer(window, np.uint8))
    total = sum(c * math.log2(c) for c in counts if c)
    return math.log2(P.WINDOW) - total / P.WINDOW


@given(st.binary(min_size=64, max_size=300).map(lambda b: bytes(x % 7 for x in b)))
@settings(max_examples=100, deadline=None)
def test_entropy_of_every_window(data):
    levels = P.entropy_levels(np.frombuffer(data, np.uint8))
    exact = [slow_level(data[i : i + 64]) / 6 * P.LEVELS for i in range(len(data) - 63)]
    assert np.abs(levels - np.array(exact)).max() <= 1


@given(st.lists(st.binary(max_size=700).map(lambda b: bytes(x % 20 + 97 for x in b)), min_size=2, max_size=5))
@settings(max_examples=60, deadline=None)
def test_texts_do_not_influence_each_other(texts):
    ranks = np.random.default_rng(0).permutation(P.LEVELS + 1).astype(np.uint16)
    together = [P.written(c) for c in P.bloom_chains(texts, ranks)]
    assert together == [P.written(P.bloom_chains([t], ranks)[0]) for t in texts]


def test_likeness_is_symmetric_and_full_for_equals():
    rng = random.Random(2)
    ranks = np.arange(P.LEVELS + 1, dtype=np.uint16)
    a, b = P.bloom_chains([prose(rng, 4000).encode(), prose(rng, 500).encode()], ranks)
    assert P.likeness(a, a) == P.likeness(b, b) == 1.0
    assert P.likeness(a, b) == P.likeness(b, a) < 0.2
    assert len(a[1]) == -(-a[0] // P.FILTER_FEATURES)


@pytest.mark.parametrize("cut", [0.25, 0.5, 0.75])
def test_likeness_falls_with_the_shared_part(cut):
    rng = random.Random(3)
    text, other = prose(rng, 6000), prose(rng, 6000)
    at = int(len(text) * cut)
    ranks = np.arange(P.LEVELS + 1, dtype=np.uint16)
    a, b = P.bloom_chains([text.encode(), (text[:at] + other[at:]).encode()], ranks)
    assert abs(P.likeness(a, b) - cut) < 0.15
