"""Hot keys and bounded blocks.

A group with many rows must not become one task. ``split_hot`` sets apart the few keys that exceed a
row limit; ``with_blocks`` cuts an ordered set into ranges of about equal size, so that an ordered
computation runs per block and only one row per block is carried on.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, materialize_counted

HOT_ROWS = 1_000_000


def split_hot(df: DataFrame, keys: list[str], limit: int = HOT_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary keys, and rows of keys with more than ``limit`` rows (None if there are none).

    Counting combines map-side. There are at most rows / limit hot keys, which bounds the broadcast.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    hot_keys = counts.where(F.col("rows") > limit).select(*keys)
    if hot_keys.isEmpty():
        return df, None
    hot_keys = F.broadcast(materialize(hot_keys))
    return df.join(hot_keys, keys, "left_anti"), df.join(hot_keys, keys, "left_semi")


def with_blocks(df: DataFrame, seq: str, rows_per_block: int = HOT_ROWS) -> DataFrame:
    """Add ``block``: consecutive ranges of ``seq`` with about ``rows_per_block`` rows each, numbered in its order.

    The input is computed once: it is written, and counted on the way. Rows are dealt out by ``seq`` itself, of whatever type, and written
    again, so that the number of a row's block stays what it is. Rows with equal ``seq`` share a block; those without come first.
    """
    rows, n = materialize_counted(df, "true")
    blocks = ceil(n / rows_per_block)
    if blocks <= 1:
        return rows.withColumn("block", F.lit(0))
    return materialize(rows.repartitionByRange(blocks, seq).withColumn("block", F.spark_partition_id()))
