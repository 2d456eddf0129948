"""Walks along next-page links, for all sites at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import materialize, materialize_counted
from .skew import split_hot

#: Sites with up to so many pages are walked by one task each.
SITE_PAGES = 200_000


def effective_cap(max_pages: Column, start_page: Column) -> Column:
    """Largest page number to process, NULL when unbounded.

    The cap is an absolute page number: a run resumed at or past it still processes one page.
    """
    return F.when(F.coalesce(max_pages, F.lit(0)) != 0, F.greatest(max_pages, start_page))


def cap_pages(pages: DataFrame) -> DataFrame:
    """Keep numbered pages up to the cap (columns page_number, start_page, max_pages)."""
    cap = effective_cap(F.col("max_pages"), F.col("start_page"))
    return pages.where(cap.isNull() | (F.col("page_number") <= cap))


def _walked(pages, starts):
    """The chains of one site, level by level: a page that was fetched with several links goes on with each."""
    import pyarrow as pa

    onward, rows, seen = {}, [], set()
    for url, following in zip(pages["url"].to_pylist(), pages["next_url"].to_pylist()):
        onward.setdefault(url, []).append(following)
    for begin in sorted(starts.to_pylist(), key=lambda s: (s["page_number"], s["url"])):
        level, page, cap = [begin["url"]], begin["page_number"], begin["cap"]
        while level and (cap is None or page <= cap):
            # with a cap a page may come again, under another number; without one it ends the chain
            here = {url: url if cap is None else (url, page) for url in level if url in onward}
            here = {url: visit for url, visit in here.items() if visit not in seen}
            seen.update(here.values())
            rows += [(page, url, following) for url in here for following in onward[url]]
            level = [following for url in here for following in onward[url] if following is not None]
            page += 1
    sites = pa.array(starts["site"].to_pylist()[:1] * len(rows), starts.schema.field("site").type)
    numbers, urls, links = zip(*rows) if rows else ((), (), ())
    columns = [sites, pa.array(numbers, pa.int64()), pa.array(urls, pa.string()), pa.array(links, pa.string())]
    return pa.table(columns, names=["site", "page_number", "url", "next_url"])


def page_chain(edges: DataFrame, starts: DataFrame, max_pages: int | None = None, site_pages: int = SITE_PAGES) -> DataFrame:
    """Pages each site visits: ``site, page_number, url, next_url``.

    ``edges``: site, url, next_url per fetched page. ``starts``: site, start_url, start_page,
    max_pages; the argument overrides the latter. A chain ends at a page without a next link or
    with a link to itself, at a link to a page that was not fetched, at the cap, and, where there is
    no cap, at the first page seen before. Rows without a site or URL belong to no chain.

    A site's pages meet in one task, which follows its links; so all sites take one shuffle, however long their chains. Sites with more than
    ``site_pages`` pages are walked by doubling instead, which never brings a site together.
    """
    own = edges.select("site", "url", F.when(F.col("next_url") != F.col("url"), F.col("next_url")).alias("next_url"))
    own = materialize(own.where("site IS NOT NULL AND url IS NOT NULL"))
    cap = F.col("max_pages") if max_pages is None else F.lit(max_pages)
    page = F.col("start_page").cast("bigint")
    begun = starts.select("site", F.col("start_url").alias("url"), page.alias("page_number"), effective_cap(cap, page).cast("bigint").alias("cap"))
    begun = begun.where("site IS NOT NULL AND url IS NOT NULL")
    few, many = split_hot(own, ["site"], site_pages)
    schema = StructType([own.schema["site"]]).add("page_number", "long").add("url", "string").add("next_url", "string")
    walked = few.groupBy("site").cogroup(begun.groupBy("site")).applyInArrow(_walked, schema)
    return walked if many is None else walked.unionByName(_by_doubling(many, begun))


def _by_doubling(own: DataFrame, begun: DataFrame) -> DataFrame:
    """``page_chain`` by doubling: round k adds the pages 2^k hops further on, so a chain of n pages takes log2(n) rounds of joins.

    Each round is one written table, which keeps plans short.
    """
    fetched = own.select("site", F.col("url").alias("target"))
    hops = own.where(F.col("next_url").isNotNull()).select("site", "url", F.col("next_url").alias("target"))
    hops = materialize(hops.join(fetched, ["site", "target"], "left_semi").select("site", "url", "target"))
    reached = materialize(begun.join(own, ["site", "url"], "left_semi"))

    distance = 1
    while True:
        further = reached.join(hops, ["site", "url"]).select(
            "site", F.col("target").alias("url"), (F.col("page_number") + distance).alias("page_number"), "cap"
        )
        # with a cap a page may come again, under another number; without one it ends the chain
        met = reached.where(F.col("cap").isNull()).select("site", "url", F.lit(True).alias("met"))
        fresh = further.join(met, ["site", "url"], "left").where(F.col("met").isNull() & (F.col("cap").isNull() | (F.col("page_number") <= F.col("cap"))))
        again = F.when(F.col("cap").isNotNull(), F.col("page_number")).alias("again")
        found = fresh.groupBy("site", "url", again).agg(F.min("page_number").alias("page_number"), F.max("cap").alias("cap"))
        found = found.drop("again").withColumn("target", F.lit(None).cast("string"))
        ahead = hops.select("site", F.col("url").alias("target"), F.col("target").alias("beyond"))
        doubled = hops.join(ahead, ["site", "target"]).select("site", "url", F.col("beyond").alias("target"))
        # both results of a round in one table: pages have a number, hops a target
        both, n_found = materialize_counted(found.unionByName(doubled, allowMissingColumns=True), "page_number IS NOT NULL")
        if not n_found:
            break
        reached = reached.unionByName(both.where("page_number IS NOT NULL").drop("target"))
        hops = both.where("target IS NOT NULL").select("site", "url", "target")
        distance *= 2
    return reached.join(own, ["site", "url"]).select("site", "page_number", "url", "next_url")
