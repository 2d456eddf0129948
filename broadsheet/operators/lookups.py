"""Dimension tables per domain: categories, authors, featured images."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import or_null
from .skew import HOT_ROWS, with_blocks


def distinct_lookups(names: DataFrame, lookup: DataFrame, column: str = "name") -> DataFrame:
    """Non-empty (domain, name) pairs not stored yet, with the first place they were seen.

    Distinct by a map-side combined aggregate, so a name on a third of all rows costs nothing extra.
    """
    fresh = names.where(or_null(column).isNotNull()).groupBy("domain", column).agg(F.min("seq").alias("seq"))
    return fresh.join(lookup.select("domain", column), ["domain", column], "left_anti")


def lookup_ids(fresh: DataFrame, lookup: DataFrame, column: str = "name", rows_per_block: int = HOT_ROWS) -> DataFrame:
    """Number new names in first-seen order, on from the largest stored id.

    Ranks are taken per block of the order and shifted by the sizes of the blocks before, so the
    global order needs no single task. The shift table has one row per block.
    """
    blocked = with_blocks(fresh, "seq", rows_per_block)
    stored = lookup.agg(F.lit(-2).alias("block"), F.coalesce(F.max("id"), F.lit(0)).cast("bigint").alias("n"))
    sizes = stored.unionByName(blocked.groupBy("block").agg(F.count(F.lit(1)).alias("n")))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select("block", F.sum("n").over(before).alias("shift"))
    rank = F.row_number().over(Window.partitionBy("block").orderBy("seq", "domain", column))
    return (
        blocked.withColumn("rank", rank)
        .join(F.broadcast(shifts), "block")
        .select((F.col("shift") + F.col("rank")).alias("id"), "domain", column)
    )


def new_lookups(names: DataFrame, lookup: DataFrame, column: str = "name", rows_per_block: int = HOT_ROWS) -> DataFrame:
    """The rows to append to a lookup table."""
    return lookup_ids(distinct_lookups(names, lookup, column), lookup, column, rows_per_block)


def merge_lookups(lookup: DataFrame, names: DataFrame, column: str = "name", rows_per_block: int = HOT_ROWS) -> DataFrame:
    """The lookup table with the new names added; stored ids never change."""
    return lookup.select("id", "domain", column).unionByName(new_lookups(names, lookup, column, rows_per_block))


def attach_lookup_ids(articles: DataFrame, lookup: DataFrame, column: str, id_column: str, name: str = "name") -> DataFrame:
    """Replace a name column by the id of its lookup row; empty names get NULL.

    No hint: images can be as many as articles. Spark broadcasts by measured size, and otherwise
    splits the skewed side.
    """
    ids = lookup.select("domain", F.col(name).alias(column), F.col("id").alias(id_column))
    return articles.withColumn(column, or_null(column)).join(ids, ["domain", column], "left").drop(column)
