"""From pages to items, next links and article records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import detail, listing
from ..functions.text import content_hash
from ..functions.urls import article_id, article_slug, image_url, inline_url, url_host, url_join


def article_record(fields: str, url: str, domain: Column) -> dict[str, Column]:
    """The record of an article whose extracted fields are the struct column ``fields``."""
    title, body, published_at = (F.col(f"{fields}.{f}") for f in ("title", "body", "published_at"))
    return {
        "domain": domain,
        "article_id": article_id(url),
        "title": title,
        "slug": article_slug(title, url),
        "body": body,
        "published_at": published_at,
        "category": F.col(f"{fields}.category"),
        "author": F.col(f"{fields}.author"),
        "featured_image": image_url(url, f"{fields}.featured_image"),
        "metadata": F.col(f"{fields}.metadata"),
        "url": F.col(url),
        "content_hash": content_hash(title, body, published_at),
    }


def extract_articles(pages: DataFrame, config: dict | Column, domain: Column | None = None) -> DataFrame:
    """Every page read as a detail page: one article record each, plus ``error``.

    Columns of ``pages`` other than url and html are passed through.
    """
    read = pages.withColumn("_fields", detail("html", config))
    record = article_record("_fields", "url", url_host("url") if domain is None else domain)
    kept = [c for c in pages.columns if c not in record and c != "html"]
    return read.select(*kept, *[c.alias(n) for n, c in record.items()], F.col("_fields.error").alias("error"))


def read_listings(pages: DataFrame, config: dict | Column) -> DataFrame:
    """Parse every page as a listing, once: ``items`` and ``next_url`` replace ``html``."""
    read = pages.withColumn("_listing", listing("html", config))
    kept = [c for c in pages.columns if c != "html"]
    next_url = F.nullif(url_join("url", "_listing.next_href"), F.col("url"))
    return read.select(
        *kept, next_url.alias("next_url"), F.col("_listing.items").alias("items"), F.col("_listing.error").alias("error")
    )


def items_of(listings: DataFrame) -> DataFrame:
    """One row per item: ``page_url, item_idx, mode, item_url, fields``.

    The index counts all items of the page; link items without an address are then dropped. An
    inline item carries its extracted ``fields`` and gets a positional URL. (The outer explode keeps
    Spark from adding a filter on the array, which would run the extraction twice.)
    """
    kept = [c for c in listings.columns if c not in ("url", "items", "next_url", "error")]
    item = listings.select(*kept, F.col("url").alias("page_url"), F.explode_outer("items").alias("item"))
    is_inline = F.col("item.article").isNotNull()
    return item.where(is_inline | F.col("item.href").isNotNull()).select(
        *kept,
        "page_url",
        F.col("item.idx").alias("item_idx"),
        F.when(is_inline, "inline").otherwise("link").alias("mode"),
        F.when(is_inline, inline_url("page_url", "item.idx"))
        .otherwise(url_join("page_url", "item.href"))
        .alias("item_url"),
        F.col("item.article").alias("fields"),
    )


def list_items(pages: DataFrame, config: dict | Column) -> DataFrame:
    return items_of(read_listings(pages, config))


def next_page(pages: DataFrame, config: dict | Column) -> DataFrame:
    """``url, next_url``; a link of a page to itself counts as none."""
    kept = [c for c in pages.columns if c != "html"]
    return read_listings(pages, config).select(*kept, "next_url")
