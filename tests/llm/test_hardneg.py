"""Hard negatives against brute force: ties, hot labels, odd rows, wide numbers, empty tables; pruning on data that clusters."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.llm import hardneg, vectors

SCHEMA = "vec_id long, label int, embedding array<double>"


def plain(rows, anchors, positives=5, negatives=3, low=50, high=95):
    held = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [math.floor(256 * x) for x in v]
        held[i] = (label, v)
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a in sorted(set(anchors) & set(held)):
        label, v = held[a]
        others = sorted((-score(v, w), i, m == label) for i, (m, w) in held.items() if i != a)
        for ps, p in [(-s, i) for s, i, same in others if same][:positives]:
            found = [(i, -s) for s, i, same in others if not same and low * ps <= -100 * s <= high * ps][:negatives]
            out += [(a, p, n, i, ps, s) for n, (i, s) in enumerate(found, 1)]
    return out


def mined(spark, rows, anchors, **more):
    out = hardneg.mine(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(a,) for a in anchors], "vec_id long"), **more)
    return sorted(map(tuple, out.collect()))


@pytest.fixture
def small_blocks(monkeypatch):
    for name, n in (("GROUP", 4), ("BLOCK", 8), ("PAGE", 3)):
        monkeypatch.setattr(hardneg, name, n)


def test_hilbert_steps_by_one():
    for d, bits in ((2, 3), (3, 2), (4, 1)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=d)))
        order = np.argsort(hardneg.hilbert(cells, bits))
        assert len(set(hardneg.hilbert(cells, bits))) == len(cells)
        assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()


@pytest.mark.parametrize("labels", [2, 40])
def test_equals_brute_force(spark, small_blocks, labels):
    rng = np.random.default_rng(labels)
    rows = [(int(i), int(x), [float(y) for y in v]) for i, x, v in zip(rng.permutation(150), rng.integers(0, labels, 150), rng.integers(-2, 3, (150, 6)) / 4)]
    anchors = list(range(0, 150, 5)) + [0, 9999]
    want = sorted(plain(rows, anchors))
    assert want and mined(spark, rows, anchors) == want
    assert mined(spark, rows, anchors, positives=1, negatives=50, low=-100, high=100) == sorted(plain(rows, anchors, 1, 50, -100, 100))


def test_equal_vectors_and_hot_label(spark, small_blocks):
    rows = [(i, 0 if i % 3 else 1, [0.5, 0.25, -0.125]) for i in range(60)] + [(100 + i, 2, [0.4, 0.25, 0.0]) for i in range(20)]
    assert mined(spark, rows, range(0, 120, 10)) == sorted(plain(rows, range(0, 120, 10)))


def test_odd_rows(spark, small_blocks):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.5]), (1, 1, [0.9, 0.5]), (2, 2, [0.6, 0.5]), (3, None, [1.0, 1.0]), (4, 1, None), (5, 1, [None, 1.0]), (6, 2, [nan, 1.0]), (7, 1, [inf, 0.0]), (None, 1, [1.0, 1.0]),
            (8, 2, [0.7]), (9, 2, []), (10, 1, [-1.0, -1.0]), (11, 2, [0.6, 0.4, 9.0]), (0, 1, [1.0, 0.5])]
    assert mined(spark, rows, [0, 1, 3, 4, 6, 9, 10, None]) == sorted(plain(rows, [0, 1, 9, 10]))
    assert mined(spark, [], [1]) == [] and mined(spark, rows, []) == []
    wide = spark.createDataFrame(rows, SCHEMA).withColumn("Vector", F.lit(1)).withColumn("place", F.lit("x"))
    assert sorted(map(tuple, hardneg.mine(wide, wide.filter("vec_id = 0")).collect())) == sorted(plain(rows, [0]))


def test_wide_components_are_exact(spark, small_blocks):
    rows = [(0, 1, [1e6, 3.0]), (1, 1, [1e6 + 1 / 256, 2.0]), (2, 2, [9e5, -7.0]), (3, 2, [5e5 + 1 / 256, 1.0]), (4, 1, [0.5, 0.25]), (5, 2, [0.25, 1e7])]
    want = plain(rows, [0, 1, 4])
    assert any(r[4] > 2 ** 53 for r in want) and mined(spark, rows, [0, 1, 4]) == sorted(want)
    with pytest.raises(OverflowError):
        vectors.products(np.array([[2.0 ** 40, 0]]), np.array([[2.0 ** 40, 1]]))


def test_far_blocks_are_not_read(spark, small_blocks):
    """Twenty tight clusters: few of the pairs of group and block are read, with the same result."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 8))
    rows = [(i, i % 2, [float(y) for y in centres[i % 20 // 2 * 2] + rng.normal(size=8) / 50]) for i in range(400)]
    assert mined(spark, rows, range(0, 400, 20), low=0, high=100) == sorted(plain(rows, range(0, 400, 20), low=0, high=100))
    placed = hardneg.placed(vectors.quantised(spark.createDataFrame(rows, SCHEMA)))
    store = hardneg.Store(placed)
    asked = placed.filter("vec_id % 20 = 0").join(hardneg.search(placed.filter("vec_id % 20 = 0").withColumn("windows", F.expr(f"array(struct(0L AS key, {hardneg.LEAST + 1}L AS low, {hardneg.MOST}L AS high))")), store, True, 5)
                                                   .groupBy(F.col("anchor").alias("vec_id")).agg(F.min("score").alias("low")), "vec_id")
    groups = hardneg._groups(asked.withColumn("windows", F.expr(f"array(struct(0L AS key, low, {hardneg.MOST}L AS high))")).drop("low"))
    assert hardneg._needs(groups, store, True).count() < 0.4 * groups.count() * store.blocks.count()
