"""Joins of pages with site configs and of items with their detail pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import url_host
from ..sources.sites import site_hosts

BROADCAST_BYTES = 64 << 20


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Hint a broadcast only after measuring the rows; larger tables are left to Spark's own choice."""
    measured = df.agg(F.sum(F.length(F.to_json(F.struct(*df.columns)))).alias("bytes"))
    size = measured.first()["bytes"] or 0
    return F.broadcast(df) if size <= max_bytes else df


def pages_with_site(pages: DataFrame, sites: DataFrame, state: DataFrame | None = None, hosts: DataFrame | None = None) -> DataFrame:
    """Pages with the configs of the sites they belong to by host, see ``site_hosts``; one row per page and site."""
    by_host = sites.join(site_hosts(sites, state, hosts), "domain").withColumnRenamed("host", "_host")
    given = pages.drop("domain") if "domain" in pages.columns else pages
    return given.join(broadcast_if_small(by_host), url_host("url") == F.col("_host")).drop("_host")


def wanted_pages(items: DataFrame, pages: DataFrame) -> DataFrame:
    """The detail pages that link items ask for, each once however many items link to it."""
    asked = items.where(F.col("mode") == "link").select(F.col("item_url").alias("url")).distinct()
    return pages.join(asked, "url", "left_semi")


def items_with_detail(items: DataFrame, details: DataFrame) -> DataFrame:
    """Attach what is known of the detail page of each item; no page means a failed fetch.

    ``details`` has one row per url (and site, where both sides have it), without html or body, so a
    page that many items link to is not multiplied. Where it is a written table, AQE can split a URL
    that a large share of the items has.
    """
    found = details.withColumnRenamed("url", "item_url").withColumn("_found", F.lit(True))
    fetch = F.when(F.col("_found") | (F.col("mode") == "inline"), "ok").otherwise("failed")
    keys = [c for c in ("site", "item_url") if c in items.columns and c in found.columns]
    return items.join(found, keys, "left").withColumn("fetch", fetch).drop("_found")
