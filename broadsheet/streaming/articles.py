"""Articles from a stream of pages, with the same outcomes and the same store as a batch run."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.html import check_configs
from ..functions.urls import article_id
from ..operators.extract import article_record, items_of
from ..operators.joins import pages_with_site
from ..operators.upsert import replay_order, skip_known
from ..plans.crawl import RECORD
from ..plans.settle import CONTENT, EVENT, settle, touched_rows
from ..session import materialize
from ..sources.pages import stream_pages
from ..sources.parsed import PAGE_KEY, ParsedPages, with_keys
from ..sources.store import Store


def events_of(pages: DataFrame, sites: DataFrame, store: Store, force: bool) -> DataFrame:
    """Staged events with their fields: a page is a detail page, or a listing of inline articles.

    A page is parsed once, and never again as long as it and its config stay what they are. Known link items are dropped before
    their fields are looked up.
    """
    listed = [c for c in ("start_urls", "hosts") if c in sites.columns]
    of_site = with_keys(pages_with_site(pages, sites.select("domain", "site", "site_order", "config", "list_page.item_is_article", *listed)))
    # A page with items of a site whose items are links is a listing, and never an article.
    lists = F.get_json_object("config", "$.list_page.item_selector").isNotNull()
    index = materialize(of_site.select("domain", "site_order", F.coalesce("item_is_article", F.lit(False)).alias("inline"), lists.alias("lists"), "arrival", *PAGE_KEY))
    parsed = ParsedPages(store.spark, f"{store.root}/parsed")
    parsed.add(of_site, index)
    rows = parsed.rows()
    heads = materialize(index.join(rows.select(*PAGE_KEY, F.coalesce(F.size("items"), F.lit(0)).alias("n_items"), "error"), PAGE_KEY))
    single = heads.where(~F.col("inline")).where(~F.col("lists") | (F.col("n_items") <= 0)).withColumns({
        "mode": F.lit("link"), "item_url": F.col("url"), "article_id": article_id("url"), "item_idx": F.lit(0),
        "fetch": F.when(F.col("error").isNull(), "ok").otherwise("failed"),
    })
    wanted = skip_known(single, touched_rows(store, single), force)
    details = wanted.join(rows.select(*PAGE_KEY, "fields"), PAGE_KEY)
    inline = heads.where("inline AND n_items > 0").join(rows.where(F.size("items") > 0).select(*PAGE_KEY, "items"), PAGE_KEY)
    items = items_of(inline.drop("error", "lists", "n_items", "inline", "html_key", "config_key")).where(F.col("mode") == "inline")
    columns = ["site", "site_order", "domain", "arrival", "item_idx", "mode", "item_url", "fetch", "fields"]
    events = details.select(*columns).unionByName(items.withColumn("fetch", F.lit("ok")).select(*columns))
    record = article_record("fields", "item_url", F.col("domain"))
    return events.select(
        "site", "domain", "mode", "item_url", "fetch",
        replay_order("site_order", "arrival", "item_idx").alias("seq"),
        record["article_id"].alias("article_id"),
        *[record[c].alias(c) for c in RECORD],
    )


def write_batch(store: Store, sites: DataFrame, pages: DataFrame, batch: str, force: bool = False) -> None:
    """Upsert one micro-batch. A batch that was committed before a restart is not applied again."""
    if store.has_batch(batch):
        return
    events = materialize(events_of(pages, sites, store, force))

    def add_content(last_events: DataFrame) -> DataFrame:
        key = ["domain", "article_id", "seq"]
        return last_events.join(events.select(*key, *CONTENT), key)

    settle(store, events.select(*EVENT), add_content, F.lit(datetime.now(timezone.utc)), force, batch=batch)


def stream_articles(
    spark: SparkSession, folder: str, sites: DataFrame, store: Store, checkpoint: str, force: bool = False,
    arrival: str = "arrival", files_per_batch: int = 1000,
) -> StreamingQuery:
    """Process the page files not seen yet and stop; a restart goes on after the last finished batch.

    The column ``arrival`` orders the pages of a batch. Batches are known by the id that the query keeps in its checkpoint,
    so several streams may feed one store, and a lost checkpoint applies all files again, which changes nothing.
    """
    sites = materialize(sites)
    check_configs(sites, walks=False)

    def write(batch: DataFrame, number: int) -> None:
        query_id = json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]
        write_batch(store, sites, batch, f"{query_id}-{number}", force)

    schema = f"url string, html string, {arrival} bigint"
    pages = stream_pages(spark, folder, schema, files_per_batch).withColumnRenamed(arrival, "arrival")
    return (
        pages.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
