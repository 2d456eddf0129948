"""Joins with a hot key are split at run time, and stay whole."""

import json

import pytest
from pyspark.sql import functions as F

from broadsheet.operators.joins import items_with_detail
from broadsheet.operators.lookups import attach_lookup_ids
from broadsheet.operators.reports import corpus_export
from broadsheet.session import materialize

# Small limits, so that a test table counts as skewed; no broadcasts, as for tables of full size.
LIMITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.shuffle.partitions": "8",
}
ROWS = 60_000


@pytest.fixture
def small_limits(spark):
    before = {k: spark.conf.get(k, None) for k in LIMITS}
    for k, v in LIMITS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot():
    """A third of the rows on one value."""
    return F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5000))


def plan_after(frame):
    rows = frame.collect()
    return rows, frame._jdf.queryExecution().executedPlan().toString()


def test_items_of_a_page_linked_from_everywhere(spark, small_limits):
    items = spark.range(0, ROWS, 1, 8).select("id", F.lit("link").alias("mode"), hot().alias("item_url"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    details = items.select(F.col("item_url").alias("url")).distinct().withColumn("digest", F.md5("url"))
    details = materialize(details)  # as in a run: an aggregate next to the join would keep it from being split
    rows, plan = plan_after(items_with_detail(items, details))
    assert len(rows) == ROWS and all(r.fetch == "ok" and r.digest for r in rows)
    assert "skew=true" in plan


def test_lookups_of_a_category_on_a_third_of_all_articles(spark, small_limits):
    articles = spark.range(0, ROWS, 1, 8).select("id", F.lit("d").alias("domain"), hot().alias("category"), F.sha2(F.col("id").cast("string"), 256).alias("pad"))
    names = articles.select("domain", F.col("category").alias("name")).distinct()
    lookup = materialize(names.withColumn("id", F.abs(F.hash("name")).cast("bigint")))
    rows, plan = plan_after(attach_lookup_ids(articles.withColumnRenamed("id", "n"), lookup, "category", "category_id"))
    assert len({r.n for r in rows}) == len(rows) == ROWS and all(r.category_id is not None for r in rows)
    assert "skew=true" in plan


def test_export_of_a_hot_category(spark, small_limits):
    articles = spark.range(0, ROWS, 1, 8).select(
        F.col("id").alias("n"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5000 + 2).cast("bigint").alias("category_id"),
        F.lit(None).cast("bigint").alias("author_id"),
        F.col("id").alias("featured_image_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )
    categories = spark.range(1, 5003).select("id", F.md5(F.col("id").cast("string")).alias("name"))
    images = spark.range(ROWS).select("id", F.md5(F.col("id").cast("string")).alias("url"))
    rows, plan = plan_after(corpus_export(articles, categories, categories, images))
    assert len({r.n for r in rows}) == len(rows) == ROWS
    assert all(r.category and r.featured_image and r.author is None for r in rows)
    assert "skew=true" in plan


def test_a_run_moves_no_html_and_parses_only_what_is_new(spark, tmp_path):
    """Pages are parsed where they are scanned, without an exchange of their html; a key that was parsed once is not parsed again."""
    from broadsheet.operators.joins import pages_with_site
    from broadsheet.plans.crawl import parse_pages, records_of
    from broadsheet.sources.parsed import PAGE_KEY, ParsedPages, with_keys

    site = {"list_page": {"item_selector": "li", "link_selector": "a"}, "article": {"title_selector": "h1"}}
    schema = "site string, domain string, config string, start_urls array<string>"
    sites = spark.createDataFrame([("s", "label", json.dumps(site), ["http://h/1"])], schema)
    state = spark.createDataFrame([], "domain string, last_url string, last_page int, updated_at timestamp")
    table = {"http://h/1": "<li><a href=2>x</a>", "http://h/2": "<h1>t</h1>", "http://h/3": None, "http://other/": "y"}
    frame = lambda: materialize(spark.createDataFrame(list(table.items()), "url string, html string"))
    parsed = ParsedPages(spark, str(tmp_path / "parsed"))
    heads, n = parse_pages(frame(), sites, state, parsed)
    assert n == 3
    assert {r.url: (r.title, r.fetch) for r in records_of(heads, parsed).collect()} == {"http://h/1": (None, "ok"), "http://h/2": ("t", "ok"), "http://h/3": (None, "failed")}
    assert parse_pages(frame(), sites, state, parsed)[1] == 0
    table |= {"http://h/2": "<h1>u</h1>", "http://h/4": "<h1>v</h1>"}
    of_site = with_keys(pages_with_site(frame(), sites, state))
    plan = parsed.reading(of_site, materialize(parsed.missing(of_site)))._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange hash" in line and "html" in line]
    heads, n = parse_pages(frame(), sites, state, parsed)
    assert n == 2 and {r.title for r in records_of(heads, parsed).collect()} == {None, "u", "v"}
    # another config reads all pages anew; repeated rows of a page are parsed once
    other = spark.createDataFrame([("s", "label", json.dumps({**site, "article": {"title_selector": "li"}}), ["http://h/1"])], schema)
    assert parse_pages(frame().unionByName(frame()), other, state, parsed)[1] == 4
    assert parsed.rows().groupBy(*PAGE_KEY).count().where("count > 1").isEmpty() and parsed.rows().count() == 9


def test_upsert_asks_the_store_for_the_batch_only(spark, tmp_path):
    from broadsheet.plans.settle import touched_rows
    from broadsheet.sources.store import Store

    store = Store(spark, str(tmp_path / "store"))
    events = spark.createDataFrame([("d", "a1"), ("e", "b7")], "domain string, article_id string")
    assert touched_rows(store, events).collect() == []
    empty = {"title": "string", "slug": "string", "body": "string", "published_at": "string", "category_id": "bigint", "author_id": "bigint", "featured_image_id": "bigint", "metadata": "map<string,array<string>>", "url": "string"}
    nulls = [f"CAST(NULL AS {t}) AS {n}" for n, t in empty.items()]
    for run, ids in ((1, ["a1", "a2", "b7", "c0", "1e"]), (2, ["a1", "c0"])):
        version = store.begin()
        rows = spark.createDataFrame([(i,) for i in ids], "id string")
        version.put("articles", rows.selectExpr("'d' AS domain", "id AS article_id", *nulls, f"'h{run}' AS content_hash", f"timestamp '2024-01-0{run}' AS scraped_at", f"timestamp '2024-01-0{run}' AS updated_at"))
        version.commit()
    assert sorted((r.article_id, r.content_hash) for r in touched_rows(store, events).collect()) == [("a1", "h2"), ("b7", "h1")]
    assert sorted((r.article_id, r.content_hash) for r in store.articles().collect()) == [("1e", "h1"), ("a1", "h2"), ("a2", "h1"), ("b7", "h1"), ("c0", "h2")]
    # only the partitions of the batch's ids are read, and of them no body
    scan = store.touched(materialize(events.select("article_id").distinct()))
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "prefix" in plan[plan.index("PartitionFilters: ["):].split("]")[0] and "a1,b7" in plan.replace(" ", "")
    assert "body" not in plan.split("ReadSchema")[1].split("\n")[0]
    partitions = {r.path.split("prefix=")[1][:2] for r in store._finished("articles").where(F.col("prefix").isin(["a1", "b7"])).select(F.col("_metadata.file_path").alias("path")).collect()}
    assert partitions == {"a1", "b7"}

