"""A schedule for one worker against a loop that waits as the worker would."""

import random

import pytest
from pyspark.sql import functions as F

from broadsheet.operators.policy import jitter_ms
from broadsheet.operators.sequential import sequential_schedule

SCHEMA = "team string, url string, seq bigint, busy bigint"


def loop(rows, jitters, delay):
    """Start of each request, by seq: every team has a clock and remembers when it asked each host."""
    clocks, asked, starts = {}, {}, {}
    for team, url, seq, busy in sorted(rows, key=lambda r: (r[2], r[1] or "")):
        host = url.split("/")[2] if url else None
        clock = clocks.get(team, 0)
        start = max(clock, asked[team, host] + delay + jitters[url]) if (team, host) in asked else clock
        starts[seq] = (start, start - clock)
        asked[team, host], clocks[team] = start, start + max(busy or 0, 0)
    return starts


def requests(seed, n, hosts, busy, teams):
    rng = random.Random(seed)
    def host():
        return "hot" if rng.random() < 0.3 else f"h{rng.randrange(hosts)}"
    return [(f"t{rng.randrange(teams)}", f"http://{host()}/p{i}", i, rng.randrange(busy + 1)) for i in range(n)]


@pytest.mark.parametrize("seed,hosts,busy,teams,rows_per_block", [
    (1, 5, 900, 1, 10**6), (2, 5, 900, 1, 25), (3, 60, 0, 1, 30), (4, 40, 200, 3, 20), (5, 2, 4000, 2, 17), (6, 200, 60, 1, 40),
])
def test_schedule_equals_a_loop(spark, seed, hosts, busy, teams, rows_per_block):
    rows = requests(seed, 240, hosts, busy, teams)
    table = spark.createDataFrame(random.Random(seed).sample(rows, len(rows)), SCHEMA)
    jitters = {r.url: r.j for r in table.select("url", jitter_ms(F.col("url"), F.lit(1.0)).alias("j")).collect()}
    plan = sequential_schedule(table, 2.0, 1.0, ("team",), F.col("busy"), rows_per_block).collect()
    assert {r.seq: (r.start_ms, r.waited_ms) for r in plan} == loop(rows, jitters, 2000) and len(plan) == len(rows)


def test_a_team_that_rests_for_some_blocks(spark):
    rows = [("a" if i < 10 or i > 90 else "b", f"http://h{i % 3}/{i}", i, 10) for i in range(100)]
    table = spark.createDataFrame(rows, SCHEMA)
    plan = sequential_schedule(table, 3.0, 0.0, ("team",), F.col("busy"), rows_per_block=9)
    assert {r.seq: (r.start_ms, r.waited_ms) for r in plan.collect()} == loop(rows, dict.fromkeys((r[1] for r in rows), 0), 3000)


@pytest.mark.parametrize("rows_per_block", [10**6, 2])
def test_odd_rows(spark, rows_per_block):
    rows = [("x", None, 1, 5), ("x", None, 2, None), (None, "http://a/1", 3, -7), (None, "http://a/2", 4, 3), ("x", "http://a/3", 5, 2), (None, "http://a/1", 6, 1)]
    table = spark.createDataFrame(rows, SCHEMA)
    plan = sequential_schedule(table, 1.0, 0.0, ("team",), F.col("busy"), rows_per_block)
    assert plan.columns == ["team", "url", "seq", "busy", "host", "gap_ms", "start_ms", "waited_ms"]
    assert {r.seq: (r.start_ms, r.waited_ms) for r in plan.collect()} == loop(rows, dict.fromkeys((r[1] for r in rows), 0), 1000)
    assert sequential_schedule(table.limit(0), 1.0, 0.0).collect() == []
    same = spark.createDataFrame([("x", "http://a/1", 1, 5)] * 3, SCHEMA)
    assert sorted(r.start_ms for r in sequential_schedule(same, 1.0, 0.0, busy_ms=F.col("busy")).collect()) == [0, 1000, 2000]


def test_matrices_hold_only_hosts_near_the_ends():
    from broadsheet.operators.sequential import _effect

    rows = 20_000
    effect = _effect([f"@{i}" for i in range(rows)], [3000] * rows, [500] * rows, 3000)
    # six requests fit into the longest gap, at either end of the block
    assert len(effect) <= 100
