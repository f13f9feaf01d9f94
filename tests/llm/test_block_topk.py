"""Top-k over a grid of several shards and groups of queries, and what its joins send to the driver."""

import random

import pytest
from pyspark.sql import functions as F

from loadstone.llm import block_topk


@pytest.fixture
def small_cells(monkeypatch):
    """Shards of 16 rows and groups of about 10 queries; the plans of what is written on the way."""
    plans = []

    def recorded(df, label, write=block_topk.written):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, label)

    for name, value in (("BLOCK", 4), ("SHARD_BLOCKS", 4), ("QUERIES", 10)):
        monkeypatch.setattr(block_topk, name, value)
    monkeypatch.setattr(block_topk, "written", recorded)
    return plans


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")


def expected(rows, every, k):
    """By plain search."""
    out = set()
    for q, v in rows:
        if q % every == 0:
            scored = sorted((-sum(round(64 * a) * round(64 * b) for a, b in zip(v, w, strict=True)), i) for i, w in rows if i != q)
            out |= {(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)}
    return out


def test_grid_of_shards_and_groups(spark, small_cells):
    """Many ties, so that a task's floors and what it holds from shard to shard decide."""
    draw = random.Random(4)
    rows = [(i, [draw.randint(-3, 3) / 64 for _ in range(3)]) for i in range(300)]
    for k in (1, 5, 40):
        best = block_topk.top_k(vectors_of(spark, rows), F.col("vec_id") % 3 == 0, k)
        assert {tuple(r) for r in best.collect()} == expected(rows, 3, k)


def test_no_side_of_a_join_goes_through_the_driver(spark, small_cells):
    """Tables small enough for Spark to broadcast: file sizes say little of queries times shards."""
    rows = [(i, [i % 7 / 64, 1.0]) for i in range(300)]
    best = block_topk.top_k(vectors_of(spark, rows), F.col("vec_id") % 3 == 0, 5)
    best.collect()
    plans = [*small_cells, best._jdf.queryExecution().executedPlan().toString()]
    assert len(plans) > 3
    for shown in plans:
        assert "Broadcast" not in shown
        assert "explode" not in shown
