"""NN-descent finds the links that brute force finds."""

import numpy as np
import pytest

from wageledger.llm import embedding_groups


def check(spark, rows):
    v = np.array(rows)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    links = np.array([(v @ x >= 0.95).sum() - 1 for x in v])
    root = np.arange(len(v))
    while True:  # the smallest id reachable
        least = np.array([root[v @ x >= 0.95].min() for x in v])
        if (least == root).all():
            break
        root = least
    frame = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rows)], "vec_id long, embedding array<double>").repartition(8)
    got = sorted(embedding_groups.near_duplicates(frame).collect())
    lost = sum(int(links[r.vec_id]) - r.n_links for r in got)
    assert lost == 0
    assert [r.component_id for r in got] == root.tolist()
    assert [r.kept for r in got] == (root == np.arange(len(v))).tolist()


@pytest.mark.parametrize("seed", range(10))
def test_every_link_is_found(spark, monkeypatch, seed):
    """Cells far smaller than the groups, and lists that are saturated at their bound."""
    monkeypatch.setattr(embedding_groups, "CELL", 48)
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(40, 16))
    near = [b + rng.normal(scale=0.01, size=16) for b, n in zip(base, [20] * 10 + [100, 8, 7, 1], strict=False) for _ in range(n)]
    check(spark, [*base, *near])


def test_blocks_and_chains(spark, monkeypatch):
    """Groups of several blocks, of which few members are saturated; chains whose ends do not link."""
    monkeypatch.setattr(embedding_groups, "CELL", 64)
    monkeypatch.setattr(embedding_groups, "BLOCK", 32)
    monkeypatch.setattr(embedding_groups, "ENLARGED", 24)
    turn = np.linspace(0, 3, 120)
    chain = np.stack([np.cos(turn), np.sin(turn), *np.zeros((6, 120))], axis=1)
    rng = np.random.default_rng(3)
    dense = chain[60] + rng.normal(scale=0.002, size=(80, 8))
    check(spark, [*chain, *dense, *rng.normal(size=(200, 8))])


def test_ten_thousand_near_copies(spark):
    rng = np.random.default_rng(4)
    near = rng.normal(size=32) + rng.normal(scale=0.01, size=(10_000, 32))
    rows = [*near, *rng.normal(size=(2000, 32))]
    frame = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rows)], "vec_id long, embedding array<double>").repartition(8)
    got = embedding_groups.near_duplicates(frame).where("vec_id < 10000").groupBy("n_links", "component_id").count().collect()
    assert [tuple(r) for r in got] == [(9999, 0, 10_000)]


def test_below_the_goal_it_fails(spark, monkeypatch):
    monkeypatch.setattr(embedding_groups, "CELL", 8)
    monkeypatch.setattr(embedding_groups, "recall", lambda true, found: 0.5)
    rows = [(i, [float(i), 1.0]) for i in range(40)]
    with pytest.raises(RuntimeError, match="recall"):
        embedding_groups.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
