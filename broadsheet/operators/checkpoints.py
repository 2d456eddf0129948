"""Per-domain resume state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import or_default


def resolve_start(sites: DataFrame, state: DataFrame) -> DataFrame:
    """Add ``start_url, start_page``: the checkpoint of the domain, else the first start URL."""
    saved = state.select("domain", "last_url", "last_page")
    has_url = F.length("last_url") > 0
    saved_page = F.coalesce(F.nullif(F.col("last_page"), F.lit(0)), F.lit(1))
    return (
        sites.join(saved, "domain", "left")
        .withColumn("start_url", or_default("last_url", F.get("start_urls", F.lit(0))))
        .withColumn("start_page", F.when(has_url, saved_page).otherwise(F.lit(1)))
        .drop("last_url", "last_page")
    )


def latest_checkpoint(writes: DataFrame) -> DataFrame:
    """The last write per domain wins (columns domain, last_url, last_page, seq)."""
    last = F.max_by(F.struct("last_url", "last_page"), F.col("seq"))
    return writes.groupBy("domain").agg(last.alias("last")).select("domain", "last.last_url", "last.last_page")


def checkpoint_after_run(state: DataFrame, walked: DataFrame, run_ts: Column) -> DataFrame:
    """State after a run over ``walked``: domain, page_number, next_url, seq.

    A last page with a next link leaves that link, also at the cap; one without deletes the
    row; a domain where no page was processed keeps its row.
    """
    page = (F.col("page_number") + 1).cast("int")
    writes = walked.select("domain", F.col("next_url").alias("last_url"), page.alias("last_page"), "seq")
    last = latest_checkpoint(writes)
    kept = state.join(last.select("domain"), "domain", "left_anti")
    moved = last.where(F.col("last_url").isNotNull()).withColumn("updated_at", run_ts)
    return kept.unionByName(moved.select(*state.columns))


def reset_state(state: DataFrame, domains: DataFrame) -> DataFrame:
    """Drop the checkpoints of the given domains."""
    return state.join(domains.select("domain"), "domain", "left_anti")
