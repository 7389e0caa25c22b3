import math
import random

import numpy as np
import pytest

from salaria.llm.mtree import Tree, top_k

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, queries, k):
    def q(v):
        return [math.floor(256 * float(np.float32(x))) for x in v]

    good = {(i, tuple(q(v))) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, v in {(i, tuple(q(v))) for i, v in queries}:
        scores = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in good if j != i)
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def vectors(rng, n, dim=8):
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(5)]
    return [(i, [x + rng.gauss(0, 0.2) for x in rng.choice(centres)]) for i in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_top_k_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = vectors(rng, 900)
    same = rows[7][1]
    rows += [(2000 + k, same) for k in range(400)]  # one vector many times: ties go to the smaller id
    rows += [(3000, None), (3001, [1.0, None] * 4), (3002, [float("nan")] * 8), (3003, [float("inf")] * 8), (None, same), rows[3], (3004, [0.0] * 8)]
    df = spark.createDataFrame(rows, SCHEMA)
    queries = [r for r in rows if r[0] is not None and r[0] % 50 == 0 and r[0] < 3000]
    got = top_k(df, spark.createDataFrame(queries, SCHEMA), page_rows=300).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute(rows, queries, 5)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_rows(spark, n):
    rows = vectors(random.Random(3), n)
    df = spark.createDataFrame(rows, SCHEMA)
    got = top_k(df, df).collect()
    assert len(got) == n * max(0, n - 1)


def block_search(tree, rows, who, k=5):
    q, ids, scores, asked = tree.search(rows[who], np.array(who), k)
    return [sorted(((int(s), int(i)) for s, i in zip(scores[q == n], ids[q == n])), key=lambda x: (-x[0], x[1])) for n in range(len(who))], asked


def test_bounds_spare_distances():
    rng = random.Random(4)
    rows = np.array([[int(x * 256) for x in v] for _, v in vectors(rng, 4000, 4)], np.int64)
    tree = Tree(np.arange(len(rows)), rows)
    total = 0
    for at in range(0, 4000, 200):
        who = list(range(at, at + 5))
        found, asked = block_search(tree, rows, who)
        for i, best in zip(who, found):
            scores = rows @ rows[i]
            order = [j for j in np.lexsort((np.arange(len(rows)), -scores)) if j != i][:5]
            assert best == [(int(scores[j]), int(j)) for j in order]
        total += asked
    assert total < 0.8 * 100 * len(rows)


@pytest.mark.parametrize("size,scale", [(60, 1), (700, 1), (700, 10**6), (700, 10**8)])
def test_blocks_equal_brute_force_at_any_scale(size, scale):
    """Also where squares pass 2**53, with ties, and with a floor from elsewhere."""
    rng = np.random.default_rng(size + scale % 97)
    rows = rng.integers(-9, 10, (size, 3)) * scale
    tree = Tree(np.arange(size), rows, int((rows * rows).sum(axis=1).max()) + 5)
    scores = rows @ rows.T
    for k in (1, 5, size + 5):
        found, _ = block_search(tree, rows, list(range(0, size, 7)), k)
        for i, best in zip(range(0, size, 7), found):
            order = [j for j in np.lexsort((np.arange(size), -scores[i])) if j != i][:k]
            assert best == [(int(scores[i, j]), j) for j in order]
    who = np.arange(0, size, 7)
    floor = np.sort(scores[who], axis=1)[:, -4]
    q, ids, got, _ = tree.search(rows[who], who, 5, floor)
    for n, i in enumerate(who):
        order = [j for j in np.lexsort((np.arange(size), -scores[i])) if j != i][:5]
        assert sorted(ids[q == n].tolist()) == sorted(j for j in order if scores[i, j] >= floor[n])


def test_pages_are_skipped_where_a_bound_from_another_page_rules_them_out(spark, monkeypatch):
    """With a bound from the nearest page, clustered queries compute a small part of all distances."""
    rng = random.Random(6)
    rows = np.array([[int(x * 256) for x in v] for _, v in vectors(rng, 4000, 4)], np.int64)
    scores = rows[:50] @ rows.T
    floor = np.sort(scores, axis=1)[:, -6]
    tree = Tree(np.arange(len(rows)), rows)
    free, bound = (tree.search(rows[:50], np.arange(50), 5, f)[3] for f in (None, floor))
    assert bound < 0.7 * free


@pytest.mark.parametrize("value", [1e8, 1e5])
def test_large_components_are_right_or_refused(spark, value):
    rng = random.Random(8)
    rows = [(i, [rng.choice((-1, 1)) * value * rng.random() for _ in range(8)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    if value > 1e7:
        with pytest.raises(ValueError, match="too large"):
            top_k(df, df.where("vec_id % 50 = 0"))
        return
    q = [[math.floor(256 * x) for x in v] for _, v in rows]
    got = {(r.query_id, r["rank"]): (r.score, r.vec_id) for r in top_k(df, df.where("vec_id % 50 = 0"), page_rows=50).collect()}
    for i in range(0, 300, 50):
        best = sorted((-sum(a * b for a, b in zip(q[i], q[j])), j) for j in range(300) if j != i)[:5]
        assert [got[i, n + 1] for n in range(5)] == [(-s, j) for s, j in best]


def test_one_row_repeated_and_one_vector_of_a_third_of_all_rows(spark):
    rng = random.Random(9)
    rows = vectors(rng, 600)
    rows += [(7, rows[7][1])] * 2000 + [(1000 + k, rows[8][1]) for k in range(900)]
    df = spark.createDataFrame(rows, SCHEMA)
    queries = [r for r in dict((r[0], r) for r in rows).values() if r[0] % 50 == 0]
    got = top_k(df, df.where("vec_id % 50 = 0"), page_rows=100).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute(rows, queries, 5)
