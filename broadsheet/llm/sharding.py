"""A uniform shuffle into shards of exact size, by a hypergeometric communication matrix (DataFrame operations only).

1. The rows are written once with their place in their input partition. Blocks of consecutive places hold at most
   ``BLOCK_ROWS`` rows whatever their values are, so no key or group can make one large.
2. How many rows of each block go to each shard is drawn before any row moves: for a uniform permutation the matrix of
   these counts is multivariate hypergeometric, with the block sizes and the shard sizes as its margins. The blocks are
   the leaves of a tree; a node deals its share of every shard out to its children by exact conditional draws, all
   nodes of a level in parallel. Rows and columns add up by construction.
3. Each block permutes its rows and cuts them by its row of the matrix; the rows are exchanged; each shard permutes what
   it got, again in cells of bounded size.

Draws and permutations hash a seed with a row's place, so a repeated task gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize

BLOCK_ROWS = 8192
FAN_BITS = 6
#: Weights beyond so many standard deviations from the mode are below the resolution of a double.
SIGMAS = 9


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _uniform(*parts: Column) -> Column:
    """A double in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) / F.lit(2.0**53)


def _walk(v: Column, down: bool, start: Column, goal: Column | None) -> Column:
    """Runs from the mode in one direction: sums the weights, or finds the value at which their sum passes ``goal``."""
    others = v.total - v.good - v.draws

    def step(s: Column, _: Column) -> Column:
        if down:
            weight = s.weight * s.k * (others + s.k) / ((v.good - s.k + 1).cast("double") * (v.draws - s.k + 1))
        else:
            weight = s.weight * (v.good - s.k) * (v.draws - s.k) / ((s.k + 1).cast("double") * (others + s.k + 1))
        k = s.k - 1 if down else s.k + 1
        at = s.at if goal is None else F.when((s.at < 0) & (s.sum + weight > goal), k).otherwise(s.at)
        return F.struct(k.alias("k"), weight.alias("weight"), (s.sum + weight).alias("sum"), at.alias("at"))

    steps = v.n_down if down else v.n_up
    return F.aggregate(F.when(steps > 0, F.sequence(F.lit(1).cast("long"), steps)).otherwise(F.array().cast("array<long>")), start, step)


def hypergeometric(total: Column, good: Column, draws: Column, u: Column) -> Column:
    """How many of ``draws`` taken without return from ``total`` with ``good`` good ones are good: the value at ``u``.

    Inversion from the mode: the weights relative to the mode's follow from the ratios of neighbours, so no factorials
    are needed, whatever the sizes are.
    """
    low, high = F.greatest(F.lit(0).cast("long"), draws - (total - good)), F.least(good, draws)
    mode = F.greatest(low, F.least(high, F.floor((draws + 1.0) * (good + 1.0) / (total + 2.0)).cast("long")))
    share = good / F.greatest(total, F.lit(1))
    spread = F.sqrt(F.greatest(F.lit(0.0), draws * share * (1 - share) * (total - draws) / F.greatest(total - 1, F.lit(1))))
    reach = (F.ceil(SIGMAS * spread) + 12).cast("long")
    start = lambda v, first, at: F.struct(v.mode.alias("k"), F.lit(1.0).alias("weight"), first.alias("sum"), at.alias("at"))
    none = F.lit(-1).cast("long")

    def draw(v: Column) -> Column:
        above = _walk(v, False, start(v, F.lit(1.0), none), None)["sum"]
        below = _walk(v, True, start(v, F.lit(0.0), none), None)["sum"]
        return _let(F.struct(above.alias("above"), (v.u * (above + below)).alias("goal")), lambda w: find(v, w))

    def find(v: Column, w: Column) -> Column:
        up = _walk(v, False, start(v, F.lit(1.0), F.when(w.goal < 1.0, v.mode).otherwise(none)), w.goal)["at"]
        down = _walk(v, True, start(v, w.above, none), w.goal)["at"]
        found = F.when(w.goal < w.above, up).otherwise(down)
        return F.when(found < 0, v.mode).otherwise(found)

    values = F.struct(
        total.alias("total"), good.alias("good"), draws.alias("draws"), u.alias("u"), mode.alias("mode"),
        F.least(high - mode, reach).alias("n_up"), F.least(mode - low, reach).alias("n_down"),
    )
    return _let(values, draw)


def _deal(left: Column, n: Column, key: Column, level: int, seed: int) -> Column:
    """``n`` rows drawn from shards with ``left`` free places: how many go to each shard."""

    def one(s: Column, place: Column) -> Column:
        return _let(place, lambda free: _let(_draw(s, free), lambda got: F.struct((s.total - free).alias("total"), (s.n - got).alias("n"), F.concat(s.out, F.array(got)).alias("out"))))

    def _draw(s: Column, free: Column) -> Column:
        u = _uniform(F.lit(seed), F.lit(level), key, F.size(s.out))
        trivial = F.when((s.n == 0) | (free == 0), F.lit(0).cast("long")).when(s.n == s.total, free)
        return trivial.otherwise(hypergeometric(s.total, free, s.n, u))

    total = F.aggregate(left, F.lit(0).cast("long"), lambda a, b: a + b)
    start = F.struct(total.alias("total"), n.alias("n"), F.array().cast("array<long>").alias("out"))
    return F.aggregate(left, start, one)["out"]


def _deal_children(left: Column, children: Column, level: int, seed: int) -> Column:
    """A node's places dealt out to its children in turn: array of (key, places)."""

    def one(s: Column, child: Column) -> Column:
        return _let(
            _deal(s.left, child.n, child.key, level, seed),
            lambda got: F.struct(
                F.zip_with(s.left, got, lambda a, b: a - b).alias("left"),
                F.concat(s.out, F.array(F.struct(child.key.alias("key"), got.alias("places")))).alias("out"),
            ),
        )

    start = F.struct(left.alias("left"), F.array().cast("array<struct<key:long,places:array<long>>>").alias("out"))
    return F.aggregate(children, start, one)["out"]


def communication_matrix(blocks: DataFrame, n_shards: int, seed: int = 0) -> DataFrame:
    """``blocks`` (key long >= 0, n long) to (key, places array<long>): rows of each block for each shard.

    The shards' sizes differ by one at most. An empty table gives an empty one.
    """
    top = blocks.agg(F.max("key").alias("key"), F.sum("n").alias("n")).first()
    if top.n is None:
        return blocks.select("key", F.array().cast("array<long>").alias("places"))
    sizes = F.lit([top.n // n_shards + (i < top.n % n_shards) for i in range(n_shards)]).cast("array<long>")
    levels, depth = [blocks.select("key", "n")], 0
    while top.key >> (FAN_BITS * depth):
        depth += 1
        child = F.struct("key", "n").alias("child")
        levels.append(
            levels[-1].groupBy(F.shiftrightunsigned("key", FAN_BITS).alias("key"))
            .agg(F.sum("n").alias("n"), F.sort_array(F.collect_list(child)).alias("children"))
        )
    nodes = levels[-1].select("key", sizes.alias("places"), *(["children"] if depth else []))
    for level in range(depth, 0, -1):
        dealt = nodes.select(F.explode(_deal_children(F.col("places"), F.col("children"), level, seed)).alias("d")).select("d.key", "d.places")
        nodes = dealt.join(levels[level - 1].select("key", "children"), "key") if level > 1 else dealt
    return nodes.select("key", "places")


def shuffle_to_shards(rows: DataFrame, n_shards: int = 40, seed: int = 0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All columns of ``rows`` plus ``shard`` (0 to ``n_shards`` - 1) and ``slot`` (gapless from 0 in each shard).

    Every row is dealt by its place, never by its values: nulls, ties and repeated rows need no care, and equal rows may
    meet or part as in any uniform shuffle. Input columns named ``shard`` or ``slot`` are replaced. An empty table gives
    an empty one. ``block_rows`` is a power of two.
    """
    bits = block_rows.bit_length() - 1
    columns = [c for c in rows.columns if c.lower() not in ("shard", "slot")]
    placed = materialize(rows.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"), F.monotonically_increasing_id().alias("place")))
    wide = placed.agg(F.max(F.shiftrightunsigned(F.expr("place & 8589934591"), bits)).alias("wide"), F.count("*").alias("n")).first()
    shift = 0 if wide.wide is None else int(wide.wide).bit_length()
    block = F.shiftleft(F.shiftrightunsigned("place", 33), shift) + F.shiftrightunsigned(F.expr("place & 8589934591"), bits)
    placed = placed.withColumn("block", block)
    counts = materialize(placed.groupBy(F.col("block").alias("key")).agg(F.count("*").alias("n")))
    matrix = materialize(communication_matrix(counts, n_shards, seed))

    in_block = Window.partitionBy("block").orderBy(F.xxhash64(F.lit(seed), "place"), "place")
    ends = F.aggregate("places", F.array().cast("array<long>"), lambda a, n: F.concat(a, F.array(n + F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0).cast("long")))))
    cuts = matrix.select(F.col("key").alias("block"), ends.alias("ends"))
    ranked = placed.withColumn("rank", F.row_number().over(in_block) - 1).join(cuts, "block")
    shard = F.size(F.filter("ends", lambda end: end <= F.col("rank")))
    cell_bits = max(0, (wide.n // n_shards // block_rows).bit_length())
    order = F.xxhash64(F.lit(seed + 1), "place")
    cell = F.shiftrightunsigned(order, 64 - cell_bits) if cell_bits else F.lit(0).cast("long")
    dealt = materialize(ranked.select("row", "place", shard.alias("shard"), order.alias("order"), cell.alias("cell")))

    cells = dealt.groupBy("shard", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    in_cell = Window.partitionBy("shard", "cell").orderBy(F.expr("`order` ^ (-9223372036854775807L - 1L)"), "place")
    slots = dealt.withColumn("rank", F.row_number().over(in_cell) - 1).join(offsets, ["shard", "cell"])
    return slots.select("row.*", "shard", (F.col("offset") + F.col("rank")).cast("long").alias("slot"))


def op4_hypergeometric_shards(spark, sf: str) -> DataFrame:
    """All documents in 40 shards by the law ``rows``."""
    text = F.coalesce("text", F.lit(""))
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    shards = shuffle_to_shards(docs, 40)
    return shards.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
