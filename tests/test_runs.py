"""Whole runs: batch, resumed, forced, streamed; the store and the config reader."""

import json
from collections.abc import Iterator

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType, StructType

from broadsheet import schemas
from broadsheet.operators.extract import extract_articles, list_items, next_page
from broadsheet.operators.reports import corpus_export
from broadsheet.plans.crawl import run
from broadsheet.session import ARROW_BYTES, materialize, work_dir
from broadsheet.sources.pages import read_html_files, read_pages, with_domain
from broadsheet.sources.parsed import BATCH_BYTES, ParsedPages, with_keys
from broadsheet.sources.sites import Defaults, read_sites, run_defaults
from broadsheet.sources.store import Store
from broadsheet.streaming.articles import stream_articles

# Two kinds of site: a timetable whose rows link to pages of stations, and a log whose entries are articles themselves.
RAIL = {
    "name": "rail", "domain": "rail.example", "start_urls": ["http://rail.example/p1.html"],
    "list_page": {"item_selector": "table.plan tr", "link_selector": "td > a"},
    "pagination": {"enabled": True, "next_selector": "nav a[rel=next]", "max_pages": None},
    "article": {"title_selector": "main h2", "body_selector": "#notes", "category_selector": "h2 + em", "featured_image_selector": "figure > img",
                "metadata_selectors": {"lines": "ol li"}},
    "request": {"delay_seconds": 0.5, "headers": {"X": "1"}},
}
LOG = {
    "name": "log", "domain": "log.example", "start_urls": ["http://log.example/"],
    "list_page": {"item_selector": "dl dd", "item_is_article": True},
    "pagination": {"enabled": True, "next_selector": "#older"},
    "article": {"body_selector": "code", "author_selector": "cite", "featured_image_selector": "kbd", "featured_image_attr": None},
}
OFF = {**RAIL, "name": "off", "domain": "off.example", "enabled": False}


def listing(number, last):
    rows = "".join(f"<tr><td>0{i}:15</td><td><a href=d{number}{i}.html>to {i}</a></td></tr>" for i in (0, 1))
    shared = "<tr><td><a href=/about.html>all stations</a></td></tr>"
    follow = f"<nav><a href=p{number - 1}.html rel=prev>back</a> <a href=p{number + 1}.html rel=next>on</a></nav>" if number < last else ""
    return f"<body><table class=plan>{rows}{shared}</table>{follow}"


def detail_page(name, body="text", category="c"):
    return f"<main><h2>Title {name}</h2><em>{category}</em><figure><img src=i/{name}.png></figure><ol><li>t</ol><p id=notes>{body} {name}</p></main>"


def rail_pages(last=3, body="text", missing=()):
    pages = {f"http://rail.example/p{n}.html": listing(n, last) for n in range(1, last + 1)}
    pages |= {f"http://rail.example/d{n}{i}.html": detail_page(f"{n}{i}", body) for n in range(1, last + 1) for i in (0, 1)}
    pages["http://rail.example/about.html"] = detail_page("about", body)
    return {u: h for u, h in pages.items() if u not in missing}


def log_page(*entries):
    return "<dl>" + "".join(f"<dt>v{i}<dd><code>{x}</code> by <cite>A</cite>" for i, x in enumerate(entries)) + "</dl>"


def frame(spark, pages):
    return with_domain(spark.createDataFrame(list(pages.items()), "url string, html string"))


@pytest.fixture
def sites_dir(tmp_path):
    folder = tmp_path / "sites"
    folder.mkdir()
    for file, config in (("a_rail", RAIL), ("b_log", LOG), ("c_off", OFF)):
        (folder / f"{file}.json").write_text(json.dumps(config, indent=1))
    return str(folder)


def report(rows):
    return {r.site: (r.inserted, r.updated, r.skipped, r.errors) for r in rows.collect()}


def test_read_sites(spark, sites_dir):
    sites = read_sites(spark, sites_dir, defaults=Defaults(delay_seconds=3.0, user_agent="ua"))
    rows = {r.site: r for r in sites.collect()}
    assert sorted(rows, key=lambda s: rows[s].site_order) == ["rail", "log"]
    assert (rows["rail"].delay_seconds, rows["rail"].jitter_seconds, rows["log"].delay_seconds) == (0.5, 1.0, 3.0)
    assert rows["rail"].headers == {"User-Agent": "ua", "X": "1"}
    assert rows["rail"].article.metadata_selectors == {"lines": "ol li"}
    assert [r.name for r in read_sites(spark, sites_dir, only=["log", "off"]).collect()] == ["log"]


def test_run_defaults(spark, tmp_path):
    path = tmp_path / "config.json"
    path.write_text(json.dumps({"defaults": {"delay_seconds": 7, "max_pages": 5, "user_agent": "x"}}))
    assert run_defaults(spark, str(path)) == Defaults(delay_seconds=7, user_agent="x")


def test_runs_over_time(spark, sites_dir, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    sites = read_sites(spark, sites_dir)
    first = {**rail_pages(missing=["http://rail.example/d31.html"]), "http://log.example/": log_page("one", "two")}
    assert report(run(store, sites, frame(spark, first))) == {"rail": (6, 0, 2, 1), "log": (2, 0, 0, 0)}
    rows = {r.url: r for r in store.articles().collect()}
    assert len(rows) == 8
    about = rows["http://rail.example/about.html"]
    assert (about.title, about.slug, about.body, about.metadata) == ("Title about", "title-about", "text about", {"lines": ["t"]})
    assert rows["http://log.example/#item-0"].body == "one" and rows["http://log.example/#item-0"].slug == "item-0"
    assert [r.name for r in store.lookup("categories").collect()] == ["c"]
    images = {r.id: r.url for r in store.lookup("images").collect()}
    assert images[about.featured_image_id] == "http://rail.example/i/about.png"
    assert sorted(images) == list(range(1, 7))
    assert store.state().count() == 0

    # Link items are known and stay as they are; inline items are compared.
    second = {**rail_pages(body="other"), "http://log.example/": log_page("one", "2", "three")}
    assert report(run(store, sites, frame(spark, second))) == {"rail": (1, 0, 8, 0), "log": (1, 1, 1, 0)}
    assert report(run(store, sites, frame(spark, second), force=True)) == {"rail": (0, 6, 3, 0), "log": (0, 0, 3, 0)}
    now = {r.url: r for r in store.articles().collect()}
    assert len(now) == 10
    changed = now["http://rail.example/about.html"]
    assert changed.body == "other about" and changed.scraped_at == about.scraped_at and changed.updated_at > about.updated_at
    assert now["http://log.example/#item-0"].updated_at == rows["http://log.example/#item-0"].updated_at

    exported = corpus_export(store.articles(), store.lookup("categories"), store.lookup("authors"), store.lookup("images"))
    assert {r.author for r in exported.where("domain = 'log.example'").collect()} == {"A"}


def test_cap_resume_and_reset(spark, sites_dir, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    sites, pages = read_sites(spark, sites_dir, only=["rail"]), frame(spark, rail_pages(4))
    state = lambda: [(r.last_url, r.last_page) for r in store.state().collect()]
    assert report(run(store, sites, pages, max_pages=1)) == {"rail": (3, 0, 0, 0)}
    assert state() == [("http://rail.example/p2.html", 2)]
    assert report(run(store, sites, pages, max_pages=1)) == {"rail": (2, 0, 1, 0)}  # past the cap: one page
    assert state() == [("http://rail.example/p3.html", 3)]
    gone = frame(spark, {u: h for u, h in rail_pages(4).items() if not u.endswith("p3.html")})
    assert report(run(store, sites, gone)) == {"rail": (0, 0, 0, 0)}
    assert state() == [("http://rail.example/p3.html", 3)]  # nothing processed, nothing moved
    assert report(run(store, sites, pages)) == {"rail": (4, 0, 2, 0)}
    assert state() == []
    run(store, sites, pages, max_pages=2)
    assert report(run(store, sites, pages, max_pages=1, reset=True)) == {"rail": (0, 0, 3, 0)}
    assert state() == [("http://rail.example/p2.html", 2)]


def test_policy_in_a_run(spark, sites_dir, tmp_path):
    rules = spark.createDataFrame(
        [("http://rail.example", 0, "*", 0, "/about", False), ("http://rail.example", 0, "*", 1, "/p2", False)],
        "origin string, entry_no int, agent string, rule_no int, path string, allow boolean",
    )
    store = Store(spark, str(tmp_path / "store"))
    sites = read_sites(spark, sites_dir, only=["rail"])
    assert report(run(store, sites, frame(spark, rail_pages()), rules=rules)) == {"rail": (2, 0, 1, 0)}
    assert [r.last_page for r in store.state().collect()] == [2]
    off = Defaults(respect_robots_txt=False)
    assert report(run(store, sites, frame(spark, rail_pages()), rules=rules, defaults=off)) == {"rail": (5, 0, 1, 0)}


def test_uncommitted_files_are_not_read(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    rows = spark.createDataFrame([(1, "d", "n")], "id bigint, domain string, name string")
    rows.write.parquet(f"{store.root}/categories/written=1")
    assert store.lookup("categories").count() == 0
    version = store.begin()
    assert [r.name for r in version.put("categories", rows.withColumn("name", F.lit("m"))).collect()] == ["m"]
    assert store.lookup("categories").count() == 0
    assert version.commit() == 1
    assert [r.name for r in store.lookup("categories").collect()] == ["m"]


def test_stream(spark, sites_dir, tmp_path):
    store, folder = Store(spark, str(tmp_path / "store")), tmp_path / "pages"
    sites = read_sites(spark, sites_dir)

    def arrive(pages, first):
        rows = [(u, h, first + i) for i, (u, h) in enumerate(pages)]
        spark.createDataFrame(rows, "url string, html string, arrival bigint").coalesce(1).write.mode("append").parquet(str(folder))
        stream_articles(spark, str(folder), sites, store, str(tmp_path / "checkpoint")).awaitTermination()

    arrive([("http://rail.example/a", detail_page("a")), ("http://log.example/", log_page("one", "two")), ("http://none.example/", "x")], 0)
    assert {r.url for r in store.articles().collect()} == {"http://rail.example/a", "http://log.example/#item-0", "http://log.example/#item-1"}
    version = store.last_run()
    arrive([("http://rail.example/a", detail_page("a", "new")), ("http://rail.example/b", detail_page("b")), ("http://log.example/", log_page("1", "two"))], 9)
    rows = {r.url: r for r in store.articles().collect()}
    assert store.last_run() == version + 1
    assert rows["http://rail.example/a"].body == "text a"  # known link items are not read again
    assert rows["http://log.example/#item-0"].body == "1" and len(rows) == 4
    stream_articles(spark, str(folder), sites, store, str(tmp_path / "checkpoint")).awaitTermination()
    assert store.last_run() == version + 1
    # A listing of links is not an article.
    arrive([("http://rail.example/p1.html", listing(1, 2))], 20)
    assert "http://rail.example/p1.html" not in {r.url for r in store.articles().collect()}
    # A lost checkpoint applies all files again, which changes nothing, and with them those that arrived meanwhile.
    checkpoint = "checkpoint2"
    one = spark.createDataFrame([("http://rail.example/z", detail_page("z"), 50)], "url string, html string, arrival bigint")
    one.coalesce(1).write.mode("append").parquet(str(folder))
    stream_articles(spark, str(folder), sites, store, str(tmp_path / checkpoint)).awaitTermination()
    hashes = {r.url: r.content_hash for r in store.articles().collect()}
    assert {u: h for u, h in hashes.items() if not u.endswith("/z")} == {u: r.content_hash for u, r in rows.items()} and len(hashes) == 5
    # A second stream into the same store has batches of its own.
    other = tmp_path / "other"
    spark.createDataFrame([("http://rail.example/y", detail_page("y"), 1)], "url string, html string, arrival bigint").write.parquet(str(other))
    stream_articles(spark, str(other), sites, store, str(tmp_path / "checkpoint3")).awaitTermination()
    assert "http://rail.example/y" in {r.url for r in store.articles().collect()}


def test_failed_pages_are_errors(spark, sites_dir, tmp_path):
    store, sites = Store(spark, str(tmp_path / "store")), read_sites(spark, sites_dir, only=["rail"])
    pages = {**rail_pages(2), "http://rail.example/d10.html": None, "http://rail.example/p2.html": None}
    assert report(run(store, sites, frame(spark, pages))) == {"rail": (2, 0, 0, 1)}
    assert [r.last_url for r in store.state().collect()] == ["http://rail.example/p2.html"]  # not processed, so it is still to do
    assert report(run(store, sites, frame(spark, rail_pages(2)))) == {"rail": (2, 0, 1, 0)}


def test_configs_are_checked_before_a_run(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    for broken in ({**RAIL, "article": {"title_selector": "li:not(.x)"}}, {k: v for k, v in RAIL.items() if k != "article"}, {**RAIL, "list_page": {}}):
        folder = tmp_path / str(len(list(tmp_path.iterdir())))
        folder.mkdir()
        (folder / "a.json").write_text(json.dumps(broken))
        with pytest.raises(ValueError):
            run(store, read_sites(spark, str(folder)), frame(spark, rail_pages()))
    for text in ('{"name": "x", ', '{"domain": "d"}'):
        (folder / "a.json").write_text(text)
        with pytest.raises(Exception):
            read_sites(spark, str(folder)).collect()


def test_domain_is_a_label(spark, tmp_path):
    (tmp_path / "sites").mkdir()
    config = {**RAIL, "domain": "example-rail", "start_urls": ["http://rail.example:8080/p1.html"], "hosts": ["www.rail.example"]}
    (tmp_path / "sites" / "a.json").write_text(json.dumps(config))
    pages = {u.replace("rail.example", "rail.example:8080"): h for u, h in rail_pages(2).items()}
    store = Store(spark, str(tmp_path / "store"))
    assert report(run(store, read_sites(spark, str(tmp_path / "sites")), frame(spark, pages))) == {"rail": (5, 0, 1, 0)}
    assert {r.domain for r in store.articles().collect()} == {"example-rail"}


def test_a_failed_run_leaves_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    rows = spark.createDataFrame([(1, "d", "kept")], "id bigint, domain string, name string")
    state = spark.createDataFrame([("d", "u", 2, None)], "domain string, last_url string, last_page int, updated_at timestamp")
    first = store.begin()
    first.put("categories", rows)
    first.put("state", state)
    first.commit()
    failed = store.begin()  # never committed
    failed.put("categories", rows.withColumn("name", F.lit("phantom")))
    failed.put("state", state.limit(0))
    assert [r.name for r in store.lookup("categories").collect()] == ["kept"] and store.state().count() == 1
    assert store.begin().commit() == 2  # a run that does not touch the state keeps it
    assert store.state().count() == 1


def test_work_folder_on_a_cluster():
    class Session:
        class conf:
            get = staticmethod(lambda key, default: None)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError):
        work_dir(Session)


def test_page_sources(spark, tmp_path):
    (tmp_path / "site" / "sub").mkdir(parents=True)
    (tmp_path / "site" / "sub" / "a.html").write_bytes("<h1>é</h1>".encode())
    got = read_html_files(spark, str(tmp_path / "site"), "http://h.example/").first()
    assert tuple(got) == ("http://h.example/sub/a.html", "<h1>é</h1>", "h.example")
    spark.createDataFrame([("http://h/x", "y")], "url string, html string").write.json(str(tmp_path / "json"))
    assert read_pages(spark, str(tmp_path / "json"), "json").first().domain == "h"


def test_extraction_operators(spark):
    pages = frame(spark, {"http://rail.example/p1.html": listing(1, 2)})
    items = list_items(pages, RAIL).orderBy("item_idx").collect()
    assert [(r.item_idx, r.mode, r.item_url) for r in items] == [
        (0, "link", "http://rail.example/d10.html"), (1, "link", "http://rail.example/d11.html"), (2, "link", "http://rail.example/about.html"),
    ]
    assert next_page(pages, RAIL).first().next_url == "http://rail.example/p2.html"
    own = frame(spark, {"http://h/p2.html": "<nav><a rel=next href=p2.html>on</a></nav>"})
    assert next_page(own, RAIL).first().next_url is None
    with pytest.raises(ValueError):
        extract_articles(pages, {"article": {"title_selector": "a:hover"}})


def test_pages_go_to_python_in_small_batches(spark, tmp_path, monkeypatch):
    """However much the session lets Spark send at a time."""

    def sizes(html, config):
        result = DataType.fromDDL(schemas.BOTH)

        def read(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            for pages, _ in batches:
                yield pa.array([{"next_href": str(pages.nbytes)}] * len(pages), to_arrow_type(result))

        return F.arrow_udf(read, result)(F.col(html), config)

    monkeypatch.setattr("broadsheet.sources.parsed.both", sizes)
    before = spark.conf.get(ARROW_BYTES)
    html = F.repeat(F.lit("x"), 1 << 20).alias("html")
    pages = with_keys(spark.range(0, 24, 1, 1).select(F.lit("s").alias("site"), F.concat(F.lit("u"), "id").alias("url"), F.lit("{}").alias("config"), html))
    parsed = ParsedPages(spark, str(tmp_path / "parsed"))
    assert parsed.add(pages, materialize(pages.select("site", "url", "html_key", "config_key"))) == 24
    rows = parsed.rows().collect()
    assert len(rows) == 24 and max(int(r.next_href) for r in rows) <= BATCH_BYTES + (2 << 20)
    assert spark.conf.get(ARROW_BYTES) == before


def test_the_store_makes_no_table_in_python(spark, tmp_path, monkeypatch):
    """Workers started for that would stay on the executors."""
    store = Store(spark, str(tmp_path / "store"))
    monkeypatch.setattr(type(spark), "createDataFrame", None)
    empty = [store.lookup("categories"), store.articles(), store.state(), store.of_walk("heads", "w"), ParsedPages(spark, str(tmp_path / "parsed")).rows()]
    assert [t.count() for t in empty] == [0] * 5
    assert [(f.name, f.dataType) for f in empty[1].schema] == [(f.name, f.dataType) for f in StructType.fromDDL(schemas.ARTICLES)]
    assert store.begin().commit("b") == 1 and store.has_batch("b") and not store.has_batch("c") and store.last_run() == 1
