"""Nearest neighbours against brute force: ranks, scores, ties and odd vectors."""

import numpy as np
import pytest

from kindred.llm import ann


def brute(rows, k=5):
    """Ranks of rows of (id, vector or None), queries those with ids divisible by 50."""
    use = list(dict.fromkeys((i, tuple(v)) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)))
    unit = [np.array(v) / max(map(abs, v)) for _, v in use]
    unit = [v / np.sqrt((v * v).sum()) for v in unit]
    out = {}
    for (i, _), q in zip(use, unit, strict=True):
        if i % 50 == 0:
            scored = sorted((-float(v @ q), j) for (j, _), v in zip(use, unit, strict=True) if j != i)
            out[i] = [(j, -s) for s, j in scored[:k]]
    return out


def found(spark, rows, **more):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    out = {}
    for r in ann.nearest(table, table.where("vec_id % 50 = 0"), **more).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert len(out[r["query_id"]]) == r["rank"]
    return out


def same(got, want):
    assert set(got) == set(want)
    for q in want:
        assert [j for j, _ in got[q]] == [j for j, _ in want[q]] and [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=1e-12)


def test_small_repeated_and_odd(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(15)]
    same(found(spark, rows), brute(rows))  # few rows: k of them all the same
    same(found(spark, rows[:4]), brute(rows[:4]))  # fewer than k
    rows += [(50, rows[3][1]), (100, [1e200 * x for x in rows[4][1]]), (101, [1e-200 * x for x in rows[4][1]]), (102, [5e-324] + [0.0] * 7)]
    odd = [(103, None), (104, [0.0] * 8), (105, [float("nan")] * 8), (106, [float("inf")] * 8), (107, [None] * 8), (108, [1.0] * 7), (150, None), (None, [1.0] * 8)]
    same(found(spark, rows + odd), brute(rows))
    same(found(spark, (rows + odd) * 10), brute(rows))


def test_copies_leave_room(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(300)]
    copied = rows * 10
    got, want = found(spark, copied), brute(rows)
    assert sum(len({j for j, _ in got[q]} & {j for j, _ in want[q]}) for q in want) >= 0.9 * 5 * len(want)
    rows += [(1000 + i, rows[0][1]) for i in range(2000)]  # a third of all in one place: its queries find five of them, the smallest ids
    got = found(spark, rows)
    assert [j for j, _ in got[0]] == [1000, 1001, 1002, 1003, 1004]
    assert all(len(v) == 5 for v in got.values())


def test_few_lists_are_widened(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [1.0, 0.001 * i]) for i in range(4)] + [(50 + i, [-1.0, 0.01 * rng.normal()]) for i in range(2000)]
    rows[4] = (4, rows[4][1])
    got, want = found(spark, rows, probed=0.01), brute(rows)
    assert [j for j, _ in got[0]][:3] == [j for j, _ in want[0]][:3] and len(got[0]) == 5
