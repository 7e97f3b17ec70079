import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tuneloom.llm import topk


def whole(v):
    if v is None or any(x is None or not math.isfinite(x) for x in v):
        return None
    return tuple(math.floor(256 * x) for x in v)


def brute(rows, k=5, step=50):
    rows = {(i, whole(v)) for i, v in rows if i is not None and whole(v) is not None}
    out = []
    for i, v in rows:
        if i % step == 0:
            best = [(-sum(a * b for a, b in zip(v, w)), j) for j, w in rows if (j, w) != (i, v) and len(w) == len(v)]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(sorted(best)[:k])]
    return sorted(out)


def found(df):
    return sorted(map(tuple, df.select("query_id", "rank", "vec_id", "score").collect()))


@pytest.fixture
def vectors(spark):
    def of(rows, kind="array<float>"):
        df = spark.createDataFrame(rows, f"vec_id bigint, embedding {kind}")
        # names that the operator uses itself
        return df.selectExpr("*", "1 AS id", "'x' AS unit", "2 AS vector", "3 AS least", "4 AS rank", "5 AS length")

    return of


def some_vectors(n=300, d=9, seed=1):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, d)).astype(np.float32)
    x[n // 2 :] = np.round(x[n // 2 :])  # many ties
    rows = [(i, v) for i, v in enumerate(x.tolist())]
    random.Random(seed).shuffle(rows)
    return rows


@pytest.mark.parametrize("bits", [1, 3, 6, 8])
def test_like_brute_force(vectors, bits):
    rows = some_vectors()
    got = topk.nearest(vectors(rows), F.col("vec_id") % 50 == 0, bits=bits, slice_rows=70)
    assert found(got) == brute(rows)
    assert dict(got.dtypes)["rank"] == "int" and dict(got.dtypes)["score"] == "bigint"


def test_other_k_doubles_and_small_blocks(vectors, monkeypatch):
    monkeypatch.setattr(topk, "TILE", 100)
    rows = some_vectors(120, 4)
    got = topk.nearest(vectors(rows, "array<double>"), F.col("vec_id") % 3 == 0, k=1, slice_rows=40)
    assert found(got) == brute(rows, 1, 3)


def test_rows_that_take_no_part(vectors):
    rows = some_vectors(60, 3)
    rows += [(100, None), (101, [1.0, None, 2.0]), (150, [float("nan")] * 3), (151, [float("inf"), 0.0, 0.0])]
    rows += [(None, [9.0, 9.0, 9.0]), (200, []), (250, []), (300, [1.0]), (350, [1.0, 2.0])]
    assert found(topk.nearest(vectors(rows), F.col("vec_id") % 50 == 0)) == brute(rows)


def test_copies_ties_and_repeated_rows(vectors):
    rows = some_vectors(40, 2)
    rows += [(i, [1.5, -0.5]) for i in range(100, 1000)]  # one very common vector
    rows += [(i, [0.0, 0.0]) for i in range(1000, 1200)]  # equal with all
    rows += [rows[0], rows[0], (50, [7.0, 7.0]), (50, [8.0, 7.0])]  # a repeated row, an id of three vectors
    assert found(topk.nearest(vectors(rows), F.col("vec_id") % 50 == 0, slice_rows=16)) == brute(rows)


def test_few_rows_and_empty_tables(vectors):
    every = F.col("vec_id") % 50 == 0
    assert found(topk.nearest(vectors([]), every)) == []
    assert found(topk.nearest(vectors([(0, [1.0])]), every)) == []
    assert found(topk.nearest(vectors([(1, [1.0])]), every)) == []
    rows = [(0, [1.0]), (1, [-1.0]), (50, [2.0])]
    assert found(topk.nearest(vectors(rows), every)) == brute(rows)


def test_scores_must_be_exact(vectors):
    with pytest.raises(Exception, match="a component is"):
        topk.nearest(vectors([(0, [1e9]), (1, [1.0])]), F.col("vec_id") % 50 == 0).collect()
    big = [(0, [8e6] * 9), (1, [8e6] * 9)]
    with pytest.raises(Exception, match="too large to be exact"):
        topk.nearest(vectors(big), F.col("vec_id") % 50 == 0).collect()


def test_bounds_hold_and_only_certain_losers_are_left_out():
    rnd = np.random.default_rng(2)
    for width in (1, 2, 5, 40):
        x, q = rnd.integers(-100, 100, (50, 6)), rnd.integers(-100, 100, (7, 6)).astype(float)
        low, w = x.min(axis=0), np.full(6, width)
        lo, hi = topk.bounds(low, w, (x - low) // w, q)
        score = q @ x.T
        assert (lo <= score).all() and (score <= hi).all() and (width > 1 or (lo == hi).all())
        rows, columns = topk.unbeaten(lo, hi, 3)
        stay = set(zip(rows.tolist(), columns.tolist()))
        for r in range(7):
            best = sorted(range(50), key=lambda c: (-score[r, c], c))[:3]
            assert all((r, c) in stay for c in best)
    assert len(topk.unbeaten(np.zeros((2, 100)), np.zeros((2, 100)), 4)[0]) == 8


def test_exact_vectors_are_read_for_few(vectors, monkeypatch):
    """Of 2,000 vectors the cells leave few, and of these not all are read."""
    seen, real = [], topk.scores

    def counted(pairs):
        seen.append(pairs.count())
        return real(pairs)

    monkeypatch.setattr(topk, "scores", counted)
    rows = [(i, v) for i, v in enumerate(np.random.default_rng(5).normal(size=(2000, 16)).tolist())]
    got = found(topk.nearest(vectors(rows), F.col("vec_id") % 500 == 0))
    assert got == brute(rows, 5, 500) and 4 * 6 <= sum(seen) < 4 * 300
