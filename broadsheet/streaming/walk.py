"""A run over pages that arrive in any order: the walk goes on whenever the page it wants has come.

Between batches stand, in the store: the heads of the pages that arrived, the pages walked, per site the URL that the walk wants next
(the frontier), and the link items whose page has not come yet (waiting). A batch adds its pages, walks on from the frontier as far
as pages reach, and settles the new items, and waiting ones, whose pages are there. All that it changes, with the checkpoints and the counters
of the report, becomes visible in the one commit that has the batch's name; a batch that was committed is not applied again, and one that was
cut off before has changed nothing.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.html import check_configs
from ..operators.chain import effective_cap, page_chain
from ..operators.checkpoints import checkpoint_after_run, resolve_start
from ..operators.policy import url_policy
from ..operators.reports import COUNTERS, run_report, site_stats
from ..operators.upsert import KEY, replay_order
from ..plans.crawl import RECORD, SITE_COLUMNS, items_on, parse_pages, records_of, staged_events
from ..plans.settle import settle, touched_rows
from ..session import materialize
from ..sources.pages import stream_pages
from ..sources.parsed import ParsedPages
from ..sources.sites import Defaults
from ..sources.store import Store

WAITING = ["site", "domain", "article_id", "seq", "mode", "item_url"]


class Walk:
    """One walk of all sites, named by ``name``; its tables are in the store."""

    def __init__(self, store: Store, sites: DataFrame, name: str, rules: DataFrame | None = None, defaults: Defaults | None = None,
                 max_pages: int | None = None, force: bool = False, hosts: DataFrame | None = None):
        listed = ["hosts"] if "hosts" in sites.columns else []
        self.store, self.name, self.rules, self.defaults = store, name, rules, defaults or Defaults()
        self.sites = materialize(sites.select(*SITE_COLUMNS, *listed))
        self.max_pages, self.force, self.hosts = max_pages, force, hosts
        self.parsed = ParsedPages(store.spark, f"{store.root}/parsed")

    def _allowed(self, urls: DataFrame) -> DataFrame:
        if self.rules is None:
            return urls.withColumn("allowed", F.lit(True))
        return url_policy(urls, self.rules, self.defaults.user_agent, self.defaults.respect_robots_txt)

    def frontier(self) -> DataFrame:
        """site, domain, url, page_number, cap, done: where each site begins, or got to."""
        saved = self.store.of_walk("frontier", self.name)
        if not saved.isEmpty():
            return saved
        starts = resolve_start(self.sites, self.store.state())
        page = F.col("start_page").cast("bigint")
        cap = effective_cap(F.col("max_pages") if self.max_pages is None else F.lit(self.max_pages), page).cast("bigint")
        return starts.select("site", "domain", F.col("start_url").alias("url"), page.alias("page_number"), cap.alias("cap"), F.lit(False).alias("done"))

    def _reached(self, frontier: DataFrame, heads: DataFrame) -> DataFrame:
        """The pages that the walk can take now. A page walked before ends a walk without a cap, as it does within a batch."""
        edges = self._allowed(heads.where("listing_error IS NULL").select("site", "url", "next_url")).where("allowed")
        again = self.store.of_walk("walked", self.name).join(frontier.where("cap IS NULL").select("site"), "site", "left_semi")
        edges = materialize(edges.select("site", "url", "next_url").join(again.select("site", "url"), ["site", "url"], "left_anti"))
        starts = frontier.where("NOT done").select("site", F.col("url").alias("start_url"), F.col("page_number").alias("start_page"), F.col("cap").alias("max_pages"))
        return materialize(page_chain(edges, starts).join(self.sites.select("site", "site_order", "domain"), "site"))

    def _moved(self, frontier: DataFrame, walked: DataFrame) -> DataFrame:
        last = walked.groupBy("site").agg(F.max_by(F.struct("next_url", "page_number"), "page_number").alias("last"))
        at = F.coalesce(F.col("last.page_number") + 1, F.col("page_number"))
        wanted = F.when(F.col("last").isNull(), F.col("url")).otherwise(F.col("last.next_url"))
        ended = F.col("done") | wanted.isNull() | F.coalesce(at > F.col("cap"), F.lit(False))
        return frontier.join(last, "site", "left").select("site", "domain", wanted.alias("url"), at.alias("page_number"), "cap", ended.alias("done"))

    def add(self, pages: DataFrame, batch: str) -> int:
        """Take in a batch of pages (url, html); returns how many of them were parsed. Of a URL that comes again the first page counts in this walk."""
        if self.store.has_batch(batch):
            return 0
        new, parsed = parse_pages(pages, self.sites, self.store.state(), self.parsed, self.hosts)
        before = self.store.of_walk("heads", self.name)
        new = materialize(new.dropDuplicates(["site", "url"]).join(before.select("site", "url"), ["site", "url"], "left_anti"))
        heads = before.unionByName(new.select(*before.columns))
        frontier = self.frontier()
        walked = self._reached(frontier, heads)
        self._settle(heads, new, self._moved(frontier, walked), walked, batch)
        return parsed

    def finish(self) -> None:
        """No more pages will come: items that still wait are failed fetches."""
        batch = f"{self.name}-end"
        if not self.store.has_batch(batch):
            heads = self.store.of_walk("heads", self.name)
            nothing = heads.limit(0)
            walked = self._reached(self.frontier().limit(0), nothing)
            self._settle(heads, nothing, self.frontier(), walked, batch, last=True)

    def _settle(self, heads: DataFrame, new: DataFrame, frontier: DataFrame, walked: DataFrame, batch: str, last: bool = False) -> None:
        found = items_on(walked, heads, self.parsed)
        waited = self.store.of_walk("waiting", self.name)
        items = materialize(found.unionByName(waited, allowMissingColumns=True))
        touched = touched_rows(self.store, items)
        # known items are settled without their page, denied ones too
        links = items.where("mode = 'link'")
        known = touched.select(*KEY).distinct().withColumn("known", F.lit(not self.force))
        checked = self._allowed(links.select("site", F.col("item_url").alias("url")).distinct())
        came = heads.select("site", "url", F.lit(True).alias("came"))
        checked = materialize(checked.join(came, ["site", "url"], "left").withColumn("came", F.coalesce("came", F.lit(False))))
        status = links.join(known, KEY, "left").join(checked.withColumnRenamed("url", "item_url"), ["site", "item_url"])
        ready = F.coalesce("known", F.lit(False)) | F.col("came") | ~F.col("allowed") | F.lit(last)
        waiting = materialize(status.where(~ready).select(*WAITING))
        settled = items.join(waiting.select(*KEY, "seq"), [*KEY, "seq"], "left_anti")

        due = checked.where("allowed AND came").select("site", "url")
        if not self.force:
            fresh = links.join(touched.select(*KEY), KEY, "left_anti").select("site", F.col("item_url").alias("url")).distinct()
            due = due.join(fresh, ["site", "url"], "left_semi")
        details = records_of(heads.join(due, ["site", "url"], "left_semi"), self.parsed)
        denied = checked.where("NOT allowed").select("site", "url", F.lit("denied").alias("fetch"))
        details = materialize(details.select("site", *RECORD, "fetch").unionByName(denied, allowMissingColumns=True))
        staged, add_content = staged_events(materialize(settled), details)

        now = F.lit(datetime.now(timezone.utc))
        after = checkpoint_after_run(self.store.state(), walked.withColumn("seq", replay_order("site_order", "page_number", F.lit(0))), now)

        def also(outcomes: DataFrame) -> dict[str, DataFrame]:
            tables = {
                "heads": new, "walked": walked.select("site", "url", "page_number"), "counters": site_stats(outcomes), "frontier": frontier, "waiting": waiting,
            }
            return {name: rows.withColumn("walk", F.lit(self.name)) for name, rows in tables.items()}

        settle(self.store, staged, add_content, now, self.force, after, batch, touched, also)

    def report(self) -> DataFrame:
        """Counters of all batches per site; a site without items has zeros."""
        sums = [F.sum(c).alias(c) for c in COUNTERS]
        return run_report(self.sites, self.store.of_walk("counters", self.name).groupBy("site").agg(*sums))


def walk_name(spark: SparkSession, checkpoint: str) -> str:
    """The id that the query keeps in its checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]


def stream_run(
    spark: SparkSession, folder: str, sites: DataFrame, store: Store, checkpoint: str, rules: DataFrame | None = None, defaults: Defaults | None = None,
    max_pages: int | None = None, force: bool = False, hosts: DataFrame | None = None, files_per_batch: int = 1000,
) -> StreamingQuery:
    """Walk the sites over the page files (url, html) not seen yet and stop; a restart goes on where the walk stands.

    Pages belong to a site by their host, see ``site_hosts``; others are not kept. ``finish_run`` settles what never came.
    """
    sites = materialize(sites)
    check_configs(sites)

    def write(batch: DataFrame, number: int) -> None:
        name = walk_name(spark, checkpoint)
        Walk(store, sites, name, rules, defaults, max_pages, force, hosts).add(batch, f"{name}-{number}")

    pages = stream_pages(spark, folder, files_per_batch=files_per_batch)
    return pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def finish_run(spark: SparkSession, sites: DataFrame, store: Store, checkpoint: str, **options) -> DataFrame:
    """End the walk of a stream, and return its report; ``options`` as for ``stream_run``."""
    walk = Walk(store, sites, walk_name(spark, checkpoint), **options)
    walk.finish()
    return walk.report()
