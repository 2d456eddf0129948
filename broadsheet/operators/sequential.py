"""Pacing for a worker that makes one request after the other, whatever their hosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.urls import url_host
from ..session import materialize
from .policy import jitter_ms
from .skew import HOT_ROWS, with_blocks

#: The worker's own name among the hosts, which begin with '@'.
WORKER = ""
NEVER = -(2**62)
#: Columns added while a schedule is made.
OWN = ["_row", "_key", "_busy", "_place"]


def _effect(keys, gaps, pauses, reach: int) -> list[tuple[str, str, int]]:
    """What a block does to times that are not known yet: (source, target, weight) rows.

    Sources are the times before the block at which the worker is free and hosts were last asked, targets the same times after it. A target is the
    largest sum of a source and its weight. No host was asked later than the worker is free, so weights that the worker's own reaches are left
    out; so are hosts whose last request lies further back than any gap.
    """
    clock: dict[str, int] = {WORKER: 0}
    last: dict[str, dict[str, int]] = {}
    for key, gap, pause in zip(keys, gaps, pauses):
        start = dict(clock)
        for source, weight in last.get(key, {key: 0}).items():
            start[source] = max(start.get(source, NEVER), weight + gap)
        floor = start[WORKER]
        start = {source: weight for source, weight in start.items() if source == WORKER or weight > floor}
        last[key] = start
        clock = {source: weight + pause for source, weight in start.items()}
    rows = [(source, WORKER, weight) for source, weight in clock.items()]
    free = clock[WORKER]
    return rows + [(s, target, w) for target, start in last.items() for s, w in start.items() if w + reach > free]


def _effects(requests: DataFrame, group: list[str], reach: int) -> DataFrame:
    """``_effect`` of every block of ``group``: source, target, weight."""
    def effect(key, rows):
        import pandas as pd

        rows = rows.sort_values("_place")
        found = _effect(rows["_key"].tolist(), rows["gap_ms"].tolist(), rows["_busy"].tolist(), reach)
        return pd.DataFrame([(*key, *row) for row in found], columns=[*group, "source", "target", "weight"])

    schema = StructType([requests.schema[c] for c in group]).add("source", "string").add("target", "string").add("weight", "long")
    return requests.select(*group, "_place", "_key", "gap_ms", "_busy").groupBy(*group).applyInPandas(effect, schema)


def _after(first: DataFrame, then: DataFrame, group: list[str], reach: int) -> DataFrame:
    """The effect of two stretches in a row.

    A time that only one of them names passes the other as it is. Where the other did ask that host, but left it out, an older time passes,
    which is never the largest.
    """
    left = first.select(*[F.col(c).alias(f"_{c}") for c in group], F.col("source").alias("origin"), F.col("target").alias("via"), F.col("weight").alias("before"))
    same = F.col("via") == F.col("source")
    for c in group:
        same &= F.col(f"_{c}").eqNullSafe(F.col(c))
    both = left.join(then, same, "full").select(
        *[F.when(F.col("via").isNotNull(), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in group],
        F.coalesce("origin", "source").alias("source"),
        F.coalesce("target", "via").alias("target"),
        (F.coalesce("before", F.lit(0)) + F.coalesce("weight", F.lit(0))).alias("weight"),
    )
    both = both.groupBy(*group, "target", "source").agg(F.max("weight").alias("weight"))
    of_worker = F.max(F.when(F.col("source") == WORKER, F.col("weight")))
    floored = both.withColumn("floor", F.coalesce(of_worker.over(Window.partitionBy(*group, "target")), F.lit(NEVER)))
    needed = floored.where((F.col("source") == WORKER) | (F.col("weight") > F.col("floor")))
    free = F.max(F.when((F.col("source") == WORKER) & (F.col("target") == WORKER), F.col("weight"))).over(Window.partitionBy(*group))
    near = (F.col("target") == WORKER) | (F.col("weight") + reach > F.col("free"))
    return needed.withColumn("free", free).where(near).drop("floor", "free")


def _before_blocks(requests: DataFrame, group: list[str], reach: int, blocks: int) -> DataFrame:
    """Per block, the times at its begin: ``key, time``. Effects of 1, 2, 4 ... blocks are put together, each round a written table."""
    effects, distance = materialize(_effects(requests, group, reach)), 1
    while distance < blocks:
        # blocks whose effect already reaches back to the first one depend on the worker alone, which begins at 0
        known = effects.where((F.col("block") >= distance) | (F.col("source") == WORKER))
        moved = known.withColumn("block", F.col("block") + distance).where(F.col("block") < blocks)
        effects, distance = materialize(_after(moved, known, group, reach)), distance * 2
    times = effects.where(F.col("source") == WORKER).withColumn("block", F.col("block") + 1)
    return times.select(*group, F.col("target").alias("key"), F.col("weight").alias("time"))


def _starts(key_rows):
    """Start and waiting time of a block's requests, of which the times before the block are known."""
    rows = key_rows.sort_values("_place")
    free, last, starts, waits = int(rows["_free"].iloc[0]), {}, [], []
    for key, gap, pause, known in zip(rows["_key"].tolist(), rows["gap_ms"].tolist(), rows["_busy"].tolist(), rows["_known"].tolist()):
        start = max(free, last.get(key, known) + gap)
        starts.append(start)
        waits.append(start - free)
        last[key], free = start, start + pause
    return rows[["_row"]].assign(start_ms=starts, waited_ms=waits)


def sequential_schedule(
    urls: DataFrame,
    delay_seconds: Column | float,
    jitter_seconds: Column | float,
    by: tuple[str, ...] = (),
    busy_ms: Column | int = 0,
    rows_per_block: int = HOT_ROWS,
) -> DataFrame:
    """Add ``host, gap_ms, start_ms, waited_ms``: when one worker starts each request, in ``seq`` order.

    A request starts when the one before it is done, ``busy_ms`` after its start, and not before the last start on its own host is ``gap_ms`` (delay
    plus jitter) ago; so a host's pause holds up all that follow. The first starts at 0. ``by`` names columns with a worker for each of their values.

    The order is cut into blocks. What a block does to the times before it is a sparse matrix of weights, under maximum and sum; matrices of stretches
    are put together by doubling, after which every block knows the times at its begin and is computed alone. A matrix names only hosts asked
    within the longest gap of the block's begin or end: so many requests as a worker can make in that time, or the block's hosts where requests take none.

    Rows with equal ``seq`` go by URL. A URL that is NULL has a host of its own; a busy time that is NULL or negative is none, a gap that is NULL is none.
    No rows give none. Columns named as one of the added are replaced.
    """
    delay, jitter = (c if isinstance(c, Column) else F.lit(float(c)) for c in (delay_seconds, jitter_seconds))
    busy = busy_ms if isinstance(busy_ms, Column) else F.lit(busy_ms)
    gap = F.round(delay * 1000).cast("bigint") + F.coalesce(jitter_ms(F.col("url"), jitter), F.lit(0))
    given = urls.withColumns({
        "host": url_host("url"), "gap_ms": F.greatest(F.coalesce(gap, F.lit(0)), F.lit(0)), "_row": F.monotonically_increasing_id(),
        "_busy": F.greatest(F.coalesce(busy.cast("bigint"), F.lit(0)), F.lit(0)),
    })
    given = given.withColumn("_key", F.coalesce(F.concat(F.lit("@"), "host"), F.lit("@@"))).drop("start_ms", "waited_ms")
    placed = with_blocks(given, "seq", rows_per_block)
    group = [*by, "block"]
    place = F.row_number().over(Window.partitionBy(*group).orderBy("seq", "url", "_busy", "_row"))
    requests = materialize(placed.select(*group, "_row", "_key", "gap_ms", "_busy", place.alias("_place")))
    reach, blocks = requests.agg(F.max("gap_ms"), F.max("block") + 1).first()
    known = requests.withColumns({"_free": F.lit(0).cast("bigint"), "_known": F.lit(NEVER).cast("bigint")})
    if blocks and blocks > 1:
        times = materialize(_before_blocks(requests, group, reach, blocks))
        known = requests
        for column, rows, none in (("_free", times.where(F.col("key") == WORKER), 0), ("_known", times.where(F.col("key") != WORKER), NEVER)):
            right = rows.select(*[F.col(c).alias(f"_of_{c}") for c in group], F.col("key").alias("_of"), F.col("time").alias(column))
            same = F.lit(True) if column == "_free" else F.col("_of") == F.col("_key")
            for c in group:
                same &= F.col(f"_of_{c}").eqNullSafe(F.col(c))
            known = known.join(right, same, "left").drop("_of", *[f"_of_{c}" for c in group]).fillna({column: none})
    starts = known.groupBy(*group).applyInPandas(_starts, "_row bigint, start_ms bigint, waited_ms bigint")
    return placed.join(starts, "_row").drop(*OWN, "block")
