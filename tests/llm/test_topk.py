import math
import random

import pytest
from pyspark.sql import functions as F

from leadloom.llm.topk import top_k


def brute(rows, k=10):
    ok = {i: [math.floor(1024 * x) for x in v] for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q in ok:
        if q % 100 == 0:
            scored = sorted((-sum(a * b for a, b in zip(ok[q], v)), i) for i, v in ok.items() if i != q)[:k]
            out |= {(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)}
    return out


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")


def found(df, **kw):
    return {tuple(r) for r in top_k(df, F.col("vec_id") % 100 == 0, **kw).collect()}


def test_ties_odd_vectors_and_blocks(spark):
    rnd = random.Random(5)
    rows = [(i, [rnd.choice([-0.5, 0.0, 0.25, 1.0]) for _ in range(37)]) for i in range(450)]
    rows += [(1000, None), (1100, [1.0, None]), (1200, [float("nan")] * 37), (1300, [float("inf")]), (1400, []), (1500, [2.0] * 5), (-100, [0.1] * 37), (None, [1.0])]
    df = vectors(spark, rows).repartition(3)
    want = brute(rows)
    assert found(df, candidates=64, queries=2, dims=8) == want
    assert found(df, candidates=10_000, queries=100, dims=100) == want


def test_pruned_search_is_exact_on_long_tailed_norms(spark):
    rnd = random.Random(6)
    rows = [(i, [rnd.gauss(0, 1) * 2 ** -(j // 8) * (10 if i % 50 == 1 else 1) for j in range(64)]) for i in range(600)]
    assert found(vectors(spark, rows), candidates=128, dims=16) == brute(rows)


def test_small_tables(spark, clashing):
    assert found(vectors(spark, [])) == set()
    assert found(vectors(spark, [(100, [1.0])])) == set()
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0])]
    assert found(clashing(vectors(spark, rows))) == brute(rows)


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(100, [1.0, 0.0]), (100, [0.0, 1.0]), (100, [0.0, 1.0]), (7, [1.0, 1.0]), (7, [1.0, 1.0]), (8, [-1.0, 0.5])]
    want = []
    for i, (q, v) in enumerate(rows):
        if q == 100:
            scored = sorted((-sum(int(1024 * a) * int(1024 * b) for a, b in zip(v, u)), c) for j, (c, u) in enumerate(rows) if j != i)
            want += [(q, r, c, -s) for r, (s, c) in enumerate(scored[:4], 1)]
    for blocks in (1, 10):
        got = top_k(vectors(spark, rows).repartition(2), F.col("vec_id") % 100 == 0, k=4, candidates=blocks, queries=1, dims=1)
        assert sorted(map(tuple, got.collect())) == sorted(want)


def test_large_components_are_exact_or_raise(spark):
    rnd = random.Random(7)
    # Sums beyond doubles; sums whose bound exceeds 64 bits though they cancel out.
    rows = [(i, [rnd.choice([-1, 1]) * (3e5 + i) for _ in range(40)]) for i in range(120)]
    assert found(vectors(spark, rows)) == brute(rows)
    rows = [(0, [3e12, 3e12, 1.0]), (1, [3e12, -3e12, 5.0]), (2, [1.0, 1.0, 1.0])]
    assert found(vectors(spark, rows)) == brute(rows)
    for odd in ([(0, [1e7] * 4096), (1, [1e7] * 4096)], [(0, [1.0]), (1, [1e300])]):
        with pytest.raises(Exception, match="64 bits"):
            found(vectors(spark, odd))
