import random

import numpy as np
import pytest

from newscov.llm import ngram_join as N
from newscov.llm.common import components

SCHEMA = "doc_id LONG, text STRING, source STRING, key STRING, component LONG, rep LONG"


def shingles(text):
    words = (text or "").split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def expected(rows):
    sets = [shingles(t) if i is not None else frozenset() for i, t in rows]
    links = [
        {j for j in range(len(rows)) if j != i and sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8}
        for i in range(len(rows))
    ]
    out = []
    for i, (ident, _) in enumerate(rows):
        seen, stack = {i}, [i]
        while stack:
            stack += (new := links[stack.pop()] - seen)
            seen |= new
        same = min((rows[j][0] for j in seen if sets[j] == sets[i] and sets[i]), default=ident)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((ident, same, len(links[i]), least, ident == least))
    return sorted(out, key=repr)


def found(spark, rows, **more):
    df = spark.createDataFrame([(*r, "s", "k", 1, 2) for r in rows], SCHEMA)
    return sorted((tuple(r) for r in N.near_documents(df, **more).collect()), key=repr)


def corpus(seed, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows = []
    for _ in range(n):
        words = [word() for _ in range(rng.choice([1, 3, 5, 40, 200]))]
        for _ in range(rng.choice([1, 1, 2, 5])):
            rows.append((len(rows), " ".join(words)))
            for _ in range(rng.choice([0, 0, 1, 2])):
                words[rng.randrange(len(words))] = word()
    return rows


@pytest.mark.parametrize("seed", [0, 1])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    assert found(spark, rows) == expected(rows)


def test_large_group_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_DOCS", 7)
    rng = random.Random(3)
    base = [str(i) for i in range(300)]
    rows = []
    for i in range(40):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(300)] = f"w{i}{rng.random()}"
        rows.append((i, " ".join(words)))
    assert found(spark, rows) == expected(rows)


def test_odd_rows(spark):
    rows = [
        (1, "a b c"), (2, "a  b\nc"), (3, None), (4, ""), (5, "   "), (6, "a b c d"), (None, "a b c"), (7, "a b c"),
        (8, "x " * 3000), (9, "x x x x x"), (10, "Ünï cødé 語 と 文"), (10, "Ünï cødé 語 と 文"),
    ]
    got = found(spark, rows)
    assert got == expected(rows)
    assert (9, 8, 1, 8, False) in got and (3, 3, 0, 3, True) in got


def test_empty_table(spark):
    assert found(spark, []) == []


def test_labels_meet_the_recall_at_the_threshold():
    assert N.label_length(0.8, 24, 6, 0.9999) == 5
    assert N.label_length(0.8, 24, 6, 0.9) == 6
    with pytest.raises(ValueError):
        N.label_length(0.8, 1, 6, 0.9999)


def test_recall_at_the_threshold():
    """Pairs of similarity 0.8 share a label as often as promised."""
    rng = np.random.default_rng(1)
    width = N.label_length(N.THRESHOLD, N.TREES, N.LONGEST, N.TARGET_RECALL)
    factors, offsets = N._coefficients(N.TREES * width, N.SEED)
    missed = 0
    for _ in range(300):
        values = rng.integers(0, 1 << 63, 110, np.uint64)
        a, b = [N.min_hashes(np.unique(v), factors, offsets).reshape(N.TREES, -1) for v in (values[:99], values[11:])]
        missed += not (a == b).all(axis=1).any()
    assert missed <= 2


def test_prefixes_differ_between_classes(spark):
    """One close partner leaves the label whole, one at the threshold shortens it, many shorten it more."""
    def missed(similarity):
        share = [N.missed_share(similarity, k, 24) for k in range(1, 6)]
        return [s / (1 - s) for s in share]

    rows = [(1, missed(0.97)), (2, missed(0.8)), *[(3, missed(0.8)) for _ in range(200)]]
    found = spark.createDataFrame(rows, "node LONG, missed ARRAY<DOUBLE>")
    got = {r.node: r.length for r in N.prefix_lengths(found, 0.8, 24, 5, 0.9999).collect()}
    assert got == {1: 5, 2: 4, 3: 3}


def borderline(n):
    """Families of three texts, each pair of which is a little above the threshold."""
    rng = random.Random(5)
    rows = []
    for family in range(n):
        base = [f"f{family}w{i}" for i in range(96)]
        for member in range(3):
            words = list(base)
            words[rng.randrange(10, 86)] = f"m{member}"
            rows.append((len(rows), " ".join(words)))
    return rows


def forest_links(rows, trees, recall, climb=True):
    """Links per row that the forest finds, in plain Python; texts differ from each other."""
    start = N.label_length(0.8, trees, N.LONGEST, recall)
    factors, offsets = N._coefficients(trees * start, N.SEED)
    sets = [shingles(t) for _, t in rows]
    labels = [N.min_hashes(N.shingles(t, N.WordHashes()), factors, offsets).reshape(trees, start).tolist() for _, t in rows]
    meets = lambda i, j, k: any(a[:k] == b[:k] for a, b in zip(labels[i], labels[j]))
    near = lambda i, j: len(sets[i] & sets[j]) / len(sets[i] | sets[j])
    n = range(len(rows))
    part = list(n)
    for i in n:
        for j in range(i):
            if meets(i, j, start):
                part = [part[j] if p == part[i] else p for p in part]
    links = {(i, j): near(i, j) for i in n for j in n if i != j and part[i] == part[j] and near(i, j) >= 0.8}
    for k in range(start - 1, 0, -1) if climb else []:
        def length(i):
            sums = {k: (1 - 0.8**k) ** trees for k in range(1, start + 1)}
            for (a, _), s in links.items():
                if a == i:
                    for k in sums:
                        sums[k] += (share := (1 - s**k) ** trees) / (1 - share)
            return max((k for k in sums if sums[k] <= 1 - recall), default=1)

        looking = [i for i in n if length(i) <= k]
        more = {(i, j) for i in looking for j in n if part[i] != part[j] and meets(i, j, k) and near(i, j) >= 0.8}
        links |= {p: near(*p) for i, j in more for p in ((i, j), (j, i))}
    return [sum(a == i for a, _ in links) for i in n]


def test_shortened_prefixes_find_what_labels_miss(spark):
    """With two trees and a low target, labels alone miss many links; the shortened prefixes bring back a good part."""
    rows = borderline(40)
    assert N.label_length(0.8, 2, 6, 0.65) == 4
    labels_only, climbed, exact = (
        forest_links(rows, 2, 0.65, climb=False), forest_links(rows, 2, 0.65), [r[2] for r in sorted(expected(rows))]
    )
    assert [r[2] for r in sorted(found(spark, rows, trees=2, target_recall=0.65))] == climbed
    assert (sum(climbed) - sum(labels_only)) * 3 >= sum(exact) - sum(labels_only) > 0


def test_shortened_prefixes_in_blocks(spark, monkeypatch):
    rows = borderline(12)
    plain = found(spark, rows, trees=2, target_recall=0.65)
    monkeypatch.setattr(N, "BLOCK_DOCS", 2)
    assert found(spark, rows, trees=2, target_recall=0.65) == plain


def test_recall_by_similarity(spark):
    """With the given values no link is lost in any band of similarity from the threshold on."""
    rows = borderline(25) + [(10_000 + i, t) for i, t in corpus(9)]
    assert found(spark, rows) == expected(rows)


@pytest.mark.parametrize("edges", [[], [(1, 2)], [(5, 4), (4, 3), (3, 9)], [(i, i + 1) for i in range(50)] + [(100, 101), (7, 7)]])
def test_components(spark, edges):
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a LONG, b LONG")).collect()}
    parent = {}
    for a, b in edges:
        if a != b:
            group = min(parent.get(a, a), parent.get(b, b))
            joined = {parent.get(a, a), parent.get(b, b)}
            parent = {k: group if v in joined else v for k, v in (parent | {a: parent.get(a, a), b: parent.get(b, b)}).items()}
    assert got == parent
