"""Temperature mixing of sources, realised as budgeted block permutations.

A source with the share p of all tokens gets a weight proportional to ``p ** x``. The exponent is bisected: the largest one
in [0, 1] whose weights reach the target entropy, but none so small that a source would be repeated more often than the
limit. A source's part of the budget is a number of passes over its documents, the last one usually not whole. In each pass
the source's blocks (of about ``BLOCK_ROWS`` rows, cut by a hash) come in an order of their own, and so do the rows in
each block; the last pass ends where the budget is used up. ``progress`` orders all rows so that every stretch of the result
has the weights. Only one row per source meets on the driver, at most ``MAX_SOURCES``.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize

TARGET_ENTROPY = 0.9
MAX_REPETITION = 4.0
BLOCK_ROWS = 4096
MAX_SOURCES = 1_000_000


def weights_at(tokens: np.ndarray, exponent: float) -> np.ndarray:
    """Normalised weights; sources without tokens weigh nothing."""
    logs = np.log(np.where(tokens > 0, tokens, 1)) * exponent
    raw = np.where(tokens > 0, np.exp(logs - logs.max(initial=0)), 0.0)
    return raw / raw.sum() if raw.sum() else raw


def entropy(weights: np.ndarray) -> float:
    w = weights[weights > 0]
    return float(-(w * np.log(w)).sum())


def budget_of(tokens: np.ndarray, weights: np.ndarray, budget: float | None) -> float:
    """The given budget, or the smallest that passes over every source once at least."""
    if budget is not None:
        return float(budget)
    used = weights > 0
    return float((tokens[used] / weights[used]).max(initial=0))


def repetition(tokens: np.ndarray, weights: np.ndarray, budget: float | None) -> float:
    used = weights > 0
    return float((weights[used] * budget_of(tokens, weights, budget) / tokens[used]).max(initial=0))


def _bisect(holds: Callable[[float], bool], low: float, high: float) -> float:
    """The border between ``low``, where it holds, and ``high``, where it may not."""
    if holds(high):
        return high
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if holds(mid) else (low, mid)
    return low


def find_exponent(tokens: np.ndarray, target_entropy: float, max_repetition: float, budget: float | None) -> float:
    """``target_entropy`` is a share of the largest possible entropy."""
    goal = target_entropy * np.log(max(1, int((tokens > 0).sum())))
    flat_enough = _bisect(lambda x: entropy(weights_at(tokens, x)) >= goal - 1e-12, 0.0, 1.0)
    if repetition(tokens, weights_at(tokens, flat_enough), budget) <= max_repetition:
        return flat_enough
    # repetition falls as the exponent rises; the limit comes before the entropy
    return _bisect(lambda x: repetition(tokens, weights_at(tokens, x), budget) <= max_repetition, 1.0, flat_enough)


def token_count(text: Column | str = "text") -> Column:
    """Words between white space; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def places(docs: DataFrame, seed: int) -> Column:
    """The hash that orders rows."""
    ids = [F.col("doc_id")] if "doc_id" in docs.columns else []
    return F.xxhash64(F.lit(seed), *ids, "text")


def mix_sources(
    docs: DataFrame, target_entropy: float = TARGET_ENTROPY, max_repetition: float = MAX_REPETITION, budget: float | None = None,
    seed: int = 0, block_rows: int = BLOCK_ROWS, decided: dict[str, Column] | None = None,
) -> DataFrame:
    """The columns of ``docs`` (with text and source) plus mix_tokens, mix_epoch and mix_progress, one row per use of a row.

    Tokens are words between white space, or what ``decided`` says: columns ``tokens`` and ``place`` (``places`` of the rows), for which no text is needed. ``budget`` in tokens; None: the smallest that uses every document once at least. A null
    source is a source of its own. A document without tokens costs nothing and comes with its block; sources without any token come once, at the
    start. Repeated rows are rows of their own. Input columns with the names of the three new ones are replaced; an empty table gives an empty one.
    """
    columns = [c for c in docs.columns if c.lower() not in ("mix_tokens", "mix_epoch", "mix_progress")]
    row = F.struct(*(F.col(f"`{c}`") for c in columns))
    tokens, place = (token_count(), places(docs, seed)) if decided is None else (decided["tokens"], decided["place"])
    base = docs.select(row.alias("row"), "source", tokens.alias("tokens"), place.alias("place"))

    found = docs.select("source", tokens.alias("tokens")).groupBy("source").agg(F.count("*").alias("n"), F.sum("tokens").alias("tokens"))
    stats = found.limit(MAX_SOURCES + 1).collect()
    if len(stats) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sizes = np.array([r.tokens for r in stats], dtype=float)
    weights = weights_at(sizes, find_exponent(sizes, target_entropy, max_repetition, budget)) if len(stats) else sizes
    total = budget_of(sizes, weights, budget)
    plan = [(r.source, float(w * total), float(r.tokens), max(0, (r.n // block_rows).bit_length())) for r, w in zip(stats, weights)]
    schema = f"source {docs.schema['source'].dataType.simpleString()}, quota double, size double, bits int"
    plans = docs.sparkSession.createDataFrame(plan, schema).withColumnRenamed("source", "plan_source")

    block = F.when(F.col("bits") > 0, F.call_function("shiftrightunsigned", F.col("place"), 64 - F.col("bits"))).otherwise(F.lit(0).cast("long"))
    planned = base.join(F.broadcast(plans), F.col("source").eqNullSafe(F.col("plan_source"))).withColumn("block", block)
    slim = docs.select("source", tokens.alias("tokens"), place.alias("place"))
    slim = slim.join(F.broadcast(plans), F.col("source").eqNullSafe(F.col("plan_source"))).withColumn("block", block)
    # a last pass of less than a billionth of a source is rounding
    passes = F.greatest(F.lit(1), F.ceil(F.col("quota") / F.greatest(F.col("size"), F.lit(1.0)) - 1e-9)).cast("int")
    epochs = F.explode(F.sequence(F.lit(0), passes - 1)).alias("mix_epoch")

    blocks = slim.groupBy("source", "block", "quota", "size").agg(F.sum("tokens").alias("in_block"))
    blocks = blocks.select("*", epochs)
    before = Window.partitionBy("source", "mix_epoch").orderBy(F.xxhash64(F.lit(seed), "mix_epoch", "block"), "block").rowsBetween(Window.unboundedPreceding, -1)
    begun = materialize(blocks.withColumn("before", F.coalesce(F.sum("in_block").over(before), F.lit(0))).select("source", "block", "mix_epoch", "before"))
    begun = begun.withColumnsRenamed({"source": "b_source", "block": "b_block", "mix_epoch": "b_epoch"})

    used = planned.select("row", "source", "tokens", "place", "block", "quota", "size", epochs)
    in_block = Window.partitionBy("source", "block", "mix_epoch").orderBy(F.xxhash64(F.lit(seed), "mix_epoch", "place"), "place").rowsBetween(Window.unboundedPreceding, -1)
    used = used.withColumn("inside", F.coalesce(F.sum("tokens").over(in_block), F.lit(0)))
    used = used.join(begun, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("block") == F.col("b_block")) & (F.col("mix_epoch") == F.col("b_epoch")))
    at = F.col("mix_epoch") * F.col("size") + F.col("before") + F.col("inside")
    # half a token of slack: quotas are products of doubles
    chosen = used.filter((at + 0.5 < F.col("quota")) | (F.col("mix_epoch") == 0) & (F.col("quota") == 0) | (F.col("mix_epoch") == 0) & (F.lit(budget is None)))
    return chosen.select("row.*", F.col("tokens").alias("mix_tokens"), "mix_epoch", F.when(F.col("quota") > 0, at / F.col("quota")).otherwise(F.lit(0.0)).alias("mix_progress"))


def op6_temperature_mix(spark, sf: str) -> DataFrame:
    """All documents mixed: which are used, in which pass, and where."""
    mixed = mix_sources(spark.read.parquet(f"{sf}/documents.parquet"))
    return mixed.select("doc_id", "source", F.col("mix_tokens").alias("tokens"), F.col("mix_epoch").alias("epoch"), F.col("mix_progress").alias("progress"))


def in_order(docs: DataFrame, partitions: int | None = None, seed: int = 0, **options) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, source, any other columns) as often as the mixture uses them and in its order, its partitions one after the other.

    What is used where is decided on digests, counts and hashes; then texts join their uses, and each goes straight to its stretch of the
    order. Rows that share doc_id, text and source are one row. ``options`` as for ``mix_sources``.
    """
    keys = {"_digest": F.coalesce(F.md5("text"), F.lit("")), "_doc": F.coalesce("doc_id", F.lit(0)), "_none": F.col("doc_id").isNull(), "_source": F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))}
    marked = docs.withColumns(keys)
    slim = materialize(marked.select(*keys, "source", token_count().alias("_tokens"), places(docs, seed).alias("_place")).dropDuplicates(list(keys)))
    uses = mix_sources(slim, seed=seed, decided={"tokens": F.col("_tokens"), "place": F.col("_place")}, **options)
    uses = materialize(uses.groupBy(*keys).agg(F.collect_list("mix_progress").alias("_uses")))
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = marked.join(uses, list(keys)).select(*docs.columns, F.explode("_uses").alias("_progress"))
    stretch = F.least(F.floor(F.col("_progress") * n), F.lit(n - 1)).cast("int")
    return placed.repartitionById(n, stretch).sortWithinPartitions("_progress", "doc_id").select(*docs.columns)
