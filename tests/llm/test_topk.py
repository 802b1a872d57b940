from __future__ import annotations

import math
import random

import numpy as np
import pytest

from postlake.llm.topk import Block, exact_scores, quantised, signed_digits, top_k


def brute(rows, k):
    """Every row against every other row, in Python integers."""
    whole = [(i, [int(x) * 1024 if abs(x) > 2**60 else math.floor(1024 * x) for x in v]) for i, v in rows]
    out = []
    for at, (q, own) in enumerate(whole):
        if q % 100 == 0:
            score = sorted((-sum(a * b for a, b in zip(own, v)), i) for n, (i, v) in enumerate(whole) if n != at)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(score)]
    return sorted(out)


def vectors(spark, rows):
    return quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))


def test_against_brute_force(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.choice([-1.0, -0.5, 0.0, 0.25, 1.0]) * rnd.choice([1, 1, 0.125]) for _ in range(8)]) for i in range(0, 900)]
    got = vectors(spark, [(*r, 0) for r in rows])
    for block_rows in (64, 10_000):
        out = top_k(got, got.filter("vec_id % 100 = 0"), 10, block_rows=block_rows)
        assert sorted(tuple(r) for r in out.collect()) == brute(rows, 10)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0], 1), (1, None, 1), (2, [1.0, None], 1), (3, [float("nan"), 1.0], 1), (4, [float("inf"), 1.0], 1), (5, [0.5, 0.5], 1), (5, [0.5, 0.5], 1), (None, [1.0, 1.0], 1), (6, [-2.0, 9.0], None), (7, [], 1)]
    v = vectors(spark, rows)
    got = [tuple(r) for r in top_k(v, v.filter("vec_id % 100 = 0")).collect()]
    # The repeated row is a candidate as often as it is there.
    assert sorted(got) == [(0, 1, 5, 512 * 1024), (0, 2, 5, 512 * 1024), (0, 3, 7, 0), (0, 4, 6, -2 * 1024 * 1024)]
    none = vectors(spark, []).limit(0)
    assert top_k(none, none).count() == 0
    assert top_k(v, v.limit(0)).count() == 0


def test_signed_digits():
    for q in [*range(-300, 300), 12345, -99999]:
        digits = signed_digits(q)
        assert sum(s << p for p, s in digits) == q
        assert all(b[0] - a[0] > 1 for a, b in zip(digits, digits[1:]))


def test_large_components_stay(spark):
    rnd = random.Random(8)
    rows = [(i, [rnd.choice([-1.0, 1.0]) * rnd.choice([0.5, 3000.0, 1e6, 2.0**18]) for _ in range(4)]) for i in range(300)]
    got = vectors(spark, [(*r, 0) for r in rows])
    out = top_k(got, got.filter("vec_id % 100 = 0"), 10, block_rows=64)
    assert sorted(tuple(r) for r in out.collect()) == brute(rows, 10)


def test_repeated_ids_are_rows_of_their_own(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([0, 0, 100, 3, 4, 5, 200 + i]), [rnd.choice([-1.0, 0.5, 1.0]) for _ in range(3)]) for i in range(150)]
    got = vectors(spark, [(*r, 0) for r in rows])
    out = top_k(got, got.filter("vec_id % 100 = 0"), 10, block_rows=16)
    assert sorted(tuple(r) for r in out.collect()) == brute(rows, 10)


def test_components_of_any_size(spark):
    """A huge component takes part; only a score that is returned has to fit a long."""
    rows = [(i, [float(i % 7), 1.0, -0.5]) for i in range(300)] + [(901, [-1e17, 0.0, 1.0]), (902, [-1e30, 2.0, 1.0]), (903, [0.0, 1e12, 1e3])]
    got = quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert got.filter("wide IS NOT NULL").count() == 2
    queries = [0, 100, 200]
    out = sorted(tuple(r) for r in top_k(got, got.filter("vec_id % 100 = 0"), 10, block_rows=64).collect())
    assert out == brute(rows, 10) and {r[0] for r in out} == set(queries)
    # As a query the huge one meets itself nowhere, and small products fit again.
    tiny = [(0, [1e30, 0.0]), (1, [0.0, 5.0]), (2, [0.0, 7.0])]
    small = quantised(spark.createDataFrame(tiny, "vec_id long, embedding array<double>"))
    assert sorted(tuple(r) for r in top_k(small, small.filter("vec_id % 100 = 0")).collect()) == [(0, 1, 1, 0), (0, 2, 2, 0)]
    large = quantised(spark.createDataFrame([*tiny, (3, [1.0, 0.0])], "vec_id long, embedding array<double>"))
    with pytest.raises(Exception, match="does not fit 64 bits"):
        top_k(large, large.filter("vec_id % 100 = 0")).collect()


def test_scores_beyond_64_bits(tmp_path):
    x = np.array([[2**62, -(2**62)], [2**62, 2**62 - 5], [-(2**62), 1], [7, 9]], np.int64)
    assert exact_scores(x, x[0]).tolist() == [sum(a * b for a, b in zip(r, x[0].tolist())) for r in x.tolist()]
    (tmp_path / "b").write_bytes(Block.file(np.arange(4), np.arange(4), x, 2, 1024))
    found, scores = Block(str(tmp_path / "b")).top(9, np.array([1, 0]), 2, 2)
    assert (found.tolist(), scores) == ([0, 1], [2**62, 2**62])
    assert Block(str(tmp_path / "b")).top(9, np.array([2**40, 0]), 2, 2)[1] == [2**102, 2**102]
