"""Nearest vectors against the exhaustive search, and how much of the corpus is read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.operators import match, nearest


@pytest.fixture
def small(monkeypatch):
    for name, n in (("BLOCK", 16), ("GROUP", 8), ("PAGE", 3), ("PIVOTS", 12)):
        monkeypatch.setattr(nearest, name, n)


def frame(spark, m, first=0):
    return spark.createDataFrame([(first + i, [float(x) for x in v]) for i, v in enumerate(m)], "vec_id long, embedding array<double>")


def plain(q, c, k, threshold=None):
    unit = lambda m: m / np.where(np.linalg.norm(m, axis=1, keepdims=True) == 0, 1, np.linalg.norm(m, axis=1, keepdims=True))
    sim = unit(q) @ unit(c).T
    out = {}
    for i, row in enumerate(sim):
        best = sorted(((-round(s, 9), j) for j, s in enumerate(row) if threshold is None or s >= threshold))[:k]
        out.update({(i, n + 1): (j, -s) for n, (s, j) in enumerate(best)})
    return out


def found(df):
    return {(r["query_id"], r["rank"]): (r["neighbour_id"], round(r["similarity"], 9)) for r in df.collect()}


@pytest.mark.parametrize("threshold", [None, 0.75, 0.2])
def test_equals_the_exhaustive_search(spark, small, threshold):
    rng = np.random.default_rng(4)
    c = np.concatenate([rng.normal(size=(90, 5)), np.repeat(rng.normal(size=(1, 5)), 30, axis=0), np.zeros((2, 5))])
    q = np.concatenate([c[::9], rng.normal(size=(20, 5)), np.zeros((1, 5))])
    got, want = found(match.knn(frame(spark, q), frame(spark, c), 4, threshold)), plain(q, c, 4, threshold)
    assert got.keys() == want.keys() and all(abs(got[x][1] - want[x][1]) < 1e-8 for x in want)
    assert all(got[x][0] == want[x][0] for x in want if sum(abs(want[x][1] - s) < 1e-8 for (i, _), (_, s) in want.items() if i == x[0]) == 1)


def test_empty_sides(spark):
    a, none = frame(spark, np.eye(3)), frame(spark, np.eye(3)).limit(0)
    assert match.knn(a, none, 2).count() == 0 and match.knn(none, a, 2).count() == 0
    assert match.knn(a, a, 9).count() == 9


def test_blocks_out_of_reach_are_skipped(spark, small):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 16))
    c = np.repeat(centres, 60, axis=0) + rng.normal(size=(720, 16)) / 40
    q = np.repeat(centres, 3, axis=0) + rng.normal(size=(36, 16)) / 40
    index = nearest.Index(frame(spark, c))
    groups = index.groups(frame(spark, q), "vec_id", "embedding")
    lows = spark.range(36).select(F.col("id").alias("query_id"), F.lit(0.9).alias("low"))
    read = index.needs(groups, lows).select(F.sum(F.size("asks"))).first()[0]
    share = read / (36 * index.blocks.count())
    assert share < 0.4, share
    got, want = found(index.search(frame(spark, q), 3, 0.9)), plain(q, c, 3, 0.9)
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}


def test_a_group_is_moved_once_to_a_shelf_of_blocks(spark, small, monkeypatch):
    monkeypatch.setattr(nearest, "SHELF", 4)
    m = np.random.default_rng(6).normal(size=(600, 6))
    index = nearest.Index(frame(spark, m))
    groups = index.groups(frame(spark, m), "vec_id", "embedding")
    needs = index.needs(groups, spark.range(600).select(F.col("id").alias("query_id"), F.lit(-1.0).alias("low")))
    blocks, n_groups = index.blocks.count(), groups.count()
    assert needs.count() == n_groups * blocks  # nothing is skipped
    moved = index.moves(needs, groups)
    assert index.shelf > 1 and moved.count() == n_groups * -(-blocks // index.shelf)
    assert moved.select(F.sum(F.size("wanted"))).first()[0] == n_groups * blocks
