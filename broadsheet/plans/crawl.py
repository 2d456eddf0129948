"""A whole run over a table of fetched pages: walk, list, extract, upsert, checkpoint, report."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import check_configs, detail
from ..functions.urls import url_join
from ..operators.chain import page_chain
from ..operators.checkpoints import checkpoint_after_run, reset_state, resolve_start
from ..operators.extract import article_record, items_of
from ..operators.joins import broadcast_if_small, items_with_detail, pages_with_site
from ..operators.policy import url_policy
from ..operators.reports import run_report, site_stats
from ..operators.upsert import replay_order, skip_known
from ..session import materialize
from ..sources.parsed import PAGE_KEY, ParsedPages, with_keys
from ..sources.sites import Defaults
from ..sources.store import Store
from .settle import CONTENT, EVENT, settle, touched_rows

SITE_COLUMNS = ["site", "site_order", "domain", "config", "start_urls", "pagination.max_pages"]
NAMES = ["category", "author", "featured_image"]
RECORD = [*CONTENT, *NAMES, "content_hash"]


def _allowed(urls: DataFrame, rules: DataFrame | None, defaults: Defaults) -> DataFrame:
    if rules is None:
        return urls.withColumn("allowed", F.lit(True))
    return url_policy(urls, rules, defaults.user_agent, defaults.respect_robots_txt)


def parse_pages(pages: DataFrame, sites: DataFrame, state: DataFrame, parsed: ParsedPages, hosts: DataFrame | None = None) -> tuple[DataFrame, int]:
    """The pages of the sites, slim: ``site, domain, url``, their keys in ``parsed``, ``next_url, listing_error, fetch``; and how many were parsed.

    Only pages that no run has parsed yet are, where they are scanned. Which pages are listings and which are wanted shows only on the
    walk, so each is read as both. Items and fields stay in ``parsed`` until they are asked for; the html ends here.
    """
    columns = [c for c in ("domain", "site", "config", "start_urls", "hosts") if c in sites.columns]
    of_site = with_keys(pages_with_site(pages, sites.select(*columns), state, hosts))
    keyed = materialize(of_site.select("domain", *PAGE_KEY))
    count = parsed.add(of_site, keyed)
    read = keyed.join(parsed.rows().select(*PAGE_KEY, "next_href", "listing_error", "error"), PAGE_KEY)
    heads = read.select(
        "domain", *PAGE_KEY,
        F.nullif(url_join("url", "next_href"), F.col("url")).alias("next_url"),
        "listing_error",
        F.when(F.col("error").isNull(), "ok").otherwise("failed").alias("fetch"),
    )
    return materialize(heads), count


def walk(listings: DataFrame, sites: DataFrame, starts: DataFrame, rules, defaults: Defaults, max_pages) -> DataFrame:
    """Listing pages each site visits. A denied or unreadable page ends its chain."""
    edges = _allowed(listings.select("site", "url", "next_url"), rules, defaults).where("allowed")
    chain = page_chain(edges if rules is None else materialize(edges), starts, max_pages)
    return materialize(chain.join(sites.select("site", "site_order", "domain"), "site"))


def items_on(walked: DataFrame, heads: DataFrame, parsed: ParsedPages) -> DataFrame:
    """Items of the walked pages in replay order, inline ones with their record."""
    listed = walked.drop("next_url").join(heads.select(*PAGE_KEY), ["site", "url"])
    lists = parsed.rows().where(F.size("items") > 0).select(*PAGE_KEY, "items")
    items = items_of(listed.join(lists, PAGE_KEY).drop("html_key", "config_key"))
    record = article_record("fields", "item_url", F.col("domain"))
    return items.select(
        "site",
        "domain",
        "page_url",
        "mode",
        "item_url",
        replay_order("site_order", "page_number", "item_idx").alias("seq"),
        record["article_id"].alias("article_id"),
        *[F.when(F.col("mode") == "inline", record[c]).alias(c) for c in RECORD],
    )


def records_of(heads: DataFrame, parsed: ParsedPages) -> DataFrame:
    """The records of some pages: ``site``, ``RECORD``, ``fetch``."""
    read = heads.select("domain", *PAGE_KEY, "fetch").join(parsed.rows().select(*PAGE_KEY, "fields"), PAGE_KEY)
    record = article_record("fields", "url", F.col("domain"))
    return read.select("site", *[record[c].alias(c) for c in RECORD], "fetch")


def details_for(items: DataFrame, heads: DataFrame, parsed: ParsedPages, pages: DataFrame, sites: DataFrame, rules, defaults: Defaults) -> DataFrame:
    """Each wanted detail page of a site: its record, or ``fetch = 'denied'``.

    Pages on the site's hosts are parsed already. Only pages elsewhere are looked up by URL, and their html with them.
    """
    wanted = items.where(F.col("mode") == "link").select("site", "domain", F.col("item_url").alias("url")).distinct()
    checked = materialize(_allowed(wanted, rules, defaults))
    allowed = checked.where("allowed").select("site", "domain", "url")
    found = records_of(heads.join(allowed.select("site", "url"), ["site", "url"], "left_semi"), parsed)
    elsewhere = materialize(allowed.join(heads.select("site", "url"), ["site", "url"], "left_anti"))
    if not elsewhere.isEmpty():
        asked = elsewhere.join(pages.select("url", "html"), "url").join(sites.select("site", "config"), "site")
        read = asked.withColumn("fields", detail("html", F.col("config")))
        record = article_record("fields", "url", F.col("domain"))
        fetch = F.when(F.col("fields.error").isNull(), "ok").otherwise("failed")
        found = found.unionByName(read.select("site", *[record[c].alias(c) for c in RECORD], fetch.alias("fetch")))
    denied = checked.where(~F.col("allowed")).select("site", "url", F.lit("denied").alias("fetch"))
    return found.unionByName(denied, allowMissingColumns=True)


def staged_events(items: DataFrame, details: DataFrame) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """Slim events of items (written) whose detail pages are ``details`` (written), and what joins the content to some of them."""
    known = details.select("site", F.col("url"), F.col("fetch").alias("page_fetch"), F.col("content_hash").alias("page_hash"),
                           *[F.col(n).alias(f"page_{n}") for n in NAMES])
    # A page that many items link to is joined without its body.
    slim = items.select("site", "domain", "article_id", "seq", "mode", "item_url", "content_hash", *NAMES)
    linked = items_with_detail(slim, known)
    staged = materialize(
        linked.withColumns({
            "fetch": F.when(F.col("mode") == "link", F.coalesce("page_fetch", "fetch")).otherwise("ok"),
            "content_hash": F.coalesce("content_hash", "page_hash"),
            **{n: F.coalesce(n, f"page_{n}") for n in NAMES},
        }).select(*EVENT)
    )

    def add_content(events: DataFrame) -> DataFrame:
        by_page = events.where(F.col("mode") == "link").withColumnRenamed("item_url", "url")
        linked = by_page.join(details.select("site", *CONTENT), ["site", "url"])
        own = items.where(F.col("mode") == "inline").select("domain", "article_id", "seq", *CONTENT)
        inline = events.where(F.col("mode") == "inline").drop("item_url").join(own, ["domain", "article_id", "seq"])
        return linked.unionByName(inline)

    return staged, add_content


def run(
    store: Store,
    sites: DataFrame,
    pages: DataFrame,
    rules: DataFrame | None = None,
    defaults: Defaults | None = None,
    max_pages: int | None = None,
    force: bool = False,
    reset: bool = False,
    run_ts: Column | None = None,
    hosts: DataFrame | None = None,
) -> DataFrame:
    """Process all given sites and commit one version of the store; returns the report per site.

    ``pages``: url, html; one row per url. A page belongs to a site by its host, see ``site_hosts``; a config that cannot
    be used raises before anything runs. A NULL html is a failed fetch. Intermediate tables go to the shared work folder; what was read from a page
    stays with the store, so only pages that are new or changed, or whose config is, are parsed.
    """
    defaults = defaults or Defaults()
    run_ts = F.lit(datetime.now(timezone.utc)) if run_ts is None else run_ts
    sites = broadcast_if_small(materialize(sites.select(*SITE_COLUMNS, *(["hosts"] if "hosts" in sites.columns else []))))
    check_configs(sites)
    state = reset_state(store.state(), sites) if reset else store.state()

    parsed = ParsedPages(store.spark, f"{store.root}/parsed")
    heads, _ = parse_pages(pages, sites, state, parsed, hosts)
    listings = heads.where("listing_error is null")
    walked = walk(listings, sites, resolve_start(sites, state), rules, defaults, max_pages)
    items = materialize(items_on(walked, listings, parsed))
    touched = touched_rows(store, items)
    fetchable = skip_known(items, touched, force)
    details = materialize(details_for(fetchable, heads, parsed, pages, sites, rules, defaults))

    staged, add_content = staged_events(items, details)
    after = checkpoint_after_run(state, walked.withColumn("seq", replay_order("site_order", "page_number", F.lit(0))), run_ts)
    outcomes = settle(store, staged, add_content, run_ts, force, after, touched=touched)
    return run_report(sites, site_stats(outcomes))
