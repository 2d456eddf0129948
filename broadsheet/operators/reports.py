"""Run statistics and the reading side of the store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Counter name and the outcome it counts.
COUNTERS = {"inserted": "inserted", "updated": "updated", "skipped": "skipped", "errors": "error"}


def site_stats(outcomes: DataFrame) -> DataFrame:
    """Four counters per site."""
    counters = [F.count_if(F.col("outcome") == value).alias(name) for name, value in COUNTERS.items()]
    return outcomes.groupBy("site").agg(*counters)


def run_report(sites: DataFrame, stats: DataFrame) -> DataFrame:
    """One row per site of the run; a site without items has zeros."""
    return sites.select("site").join(stats, "site", "left").na.fill(0, list(COUNTERS))


def items_per_page(items: DataFrame) -> DataFrame:
    return items.groupBy("page_url").agg(F.count(F.lit(1)).alias("items"))


def corpus_columns(articles: DataFrame) -> DataFrame:
    """The columns the next stage reads."""
    return articles.select("domain", "title", "body", "published_at", "category_id", "metadata")


def corpus_export(articles: DataFrame, categories: DataFrame, authors: DataFrame, images: DataFrame) -> DataFrame:
    """Articles with the names behind their lookup ids."""
    exported = articles
    for lookup, id_column, value, name in (
        (categories, "category_id", "name", "category"),
        (authors, "author_id", "name", "author"),
        (images, "featured_image_id", "url", "featured_image"),
    ):
        named = lookup.select(F.col("id").alias(id_column), F.col(value).alias(name))
        exported = exported.join(named, id_column, "left")
    return exported


def articles_by_category(export: DataFrame) -> DataFrame:
    return export.groupBy("domain", "category").agg(
        F.count(F.lit(1)).alias("articles"),
        F.count("body").alias("with_body"),
        F.sum(F.coalesce(F.length("body"), F.lit(0))).cast("bigint").alias("body_chars"),
    )
