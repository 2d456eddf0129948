import random
import re

import numpy as np
from pyspark.sql import functions as F

from broadsheet.llm.negatives import Block, hard_negatives, quantised, threshold_search

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, is_anchor):
    """(anchor, positive, rank, negative, scores) by comparing every anchor with every row."""
    rows = sorted({(v, label, tuple(int(np.floor(256 * float(np.float32(x)))) for x in e)) for v, e, label in rows if v is not None and label is not None and e is not None and all(x is not None and np.isfinite(x) for x in e)})
    out = []
    for a in rows:
        if not is_anchor(a[0]):
            continue
        scored = [(-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1]) for b in rows if b is not a]
        scored.sort()
        for s, p, _ in [x for x in scored if x[2] == a[1]][:5]:
            fits = [(n, i) for n, i, label in scored if label != a[1] and 80 * -s <= 100 * -n <= 100 * -s][:5]
            out += [(a[0], p, rank, i, -s, -n) for rank, (n, i) in enumerate(fits, 1)]
    return sorted(out)


def found(spark, rows, **options):
    table = spark.createDataFrame(rows, SCHEMA).select("vec_id", "label", quantised("embedding").alias("vector"))
    got = hard_negatives(table, F.col("vec_id") % 10 == 0, **options).collect()
    return sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got)


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr("broadsheet.llm.negatives.BLOCK_ROWS", (32, 64))
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 6))
    rows = [(i, (centres[i % 4] + rng.normal(size=6) * (0.2 if i % 3 else 1.5)).tolist(), int(i * 7 % 3)) for i in range(300)]
    # ties: copies of a vector under both labels, the anchor's among them, more than any window takes
    rows += [(1000 + i, rows[20][1], i % 3) for i in range(120)]
    expected = brute(rows, lambda v: v % 10 == 0)
    assert found(spark, rows) == expected and len(expected) > 200


def test_anchors_sent_to_blocks_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr("broadsheet.llm.negatives.BLOCK_ROWS", (16, 16))
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=6).tolist(), i % 3) for i in range(200)]
    table = spark.createDataFrame(rows, SCHEMA).select("vec_id", "label", quantised("embedding").alias("vector"))
    frame = hard_negatives(table, F.col("vec_id") % 10 == 0)
    plan = lambda: frame._jdf.queryExecution().executedPlan().toString()
    planned = plan()
    got = sorted((r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in frame.collect())
    assert got == brute(rows, lambda v: v % 10 == 0) and got
    # of small tables, which Spark would broadcast: the join below the search, as planned and as it ran
    joins = [re.search(r"\w+Join", below)[0] for p in (planned, plan()) for below in p.split("MapInArrow")[1:]]
    assert len(joins) > 1 and set(joins) == {"SortMergeJoin"}


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (1, [1.0, 0.4], 1), (2, [0.9, 0.5], 2), (3, [nan, 1.0], 2), (4, [inf, 1.0], 1), (5, None, 1), (6, [1.0, None], 2), (7, [1.0, 0.4], None), (None, [1.0, 0.4], 1)]
    rows += [(8, [0.95], 2), (0, [1.0, 0.5], 1), (9, [1.0, 0.3, -2.0], 2), (10, [], 1), (11, [], 2), (20, [0.0, 0.0], 2), (30, [-1.0, -1.0], 3), (31, [1.0, 1.0], 3), (40, [3e5, 1e5], 4), (41, [3e5, 1e5], 4), (42, [2.9e5, 1e5], 5)]
    assert found(spark, rows) == brute(rows, lambda v: v % 10 == 0)
    assert found(spark, []) == [] and found(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []


def test_search_stops_early_and_loses_nothing():
    rng = random.Random(1)
    members = np.array([[rng.randint(-300, 300) for _ in range(3)] for _ in range(4000)], np.float64)
    block = Block(np.arange(4000), np.zeros(4000, np.int64), members, np.argsort(members, axis=0, kind="stable").T)
    shallow = 0
    for _ in range(40):
        anchor = np.array([rng.choice([0, rng.randint(-300, 300)]) for _ in range(3)], np.float64)
        high = rng.choice([10**9, 60_000, 0])
        (scores, ids), = threshold_search(block, anchor, np.ones(4000, bool), [(-(10**9), high)], 5)[0]
        every = sorted((-int(s), i) for i, s in enumerate(members @ anchor) if s <= high)[:5]
        assert [(-s, i) for s, i in zip(scores, ids)] == every
        shallow += threshold_search(block, anchor, np.ones(4000, bool), [(-(10**9), 10**9)], 5)[1] < 4000
    assert shallow > 20


def test_scores_beyond_floating_point():
    members = np.array([[2.0**40, 2.0**30, 1], [2.0**40, 2.0**30, 0]])
    block = Block(np.arange(2), np.zeros(2, np.int64), members, np.argsort(members, axis=0, kind="stable").T)
    assert block.scores(np.array([2.0**20, 3, 1]), np.arange(2)).tolist() == [2**60 + 3 * 2**30 + 1, 2**60 + 3 * 2**30]
    assert block.scores(np.array([2.0**40, 0, 0]), np.arange(1)).tolist() == [2**63 - 1]
