"""A walk over pages in any order of arrival equals a run over all of them."""

import json

import pytest

from broadsheet.operators.reports import corpus_export
from broadsheet.plans.crawl import run
from broadsheet.sources.sites import read_sites
from broadsheet.sources.store import Run, Store
from broadsheet.streaming.walk import Walk
from test_runs import LOG, RAIL, frame, log_page, rail_pages, report


@pytest.fixture
def sites(spark, tmp_path):
    (tmp_path / "sites").mkdir()
    log = {**LOG, "pagination": {"enabled": True, "next_selector": "#older", "max_pages": 2}}
    for name, config in (("a", RAIL), ("b", log)):
        (tmp_path / "sites" / f"{name}.json").write_text(json.dumps(config))
    return read_sites(spark, str(tmp_path / "sites"))


PAGES = {
    **rail_pages(4, missing=("http://rail.example/d31.html",)),
    "http://rail.example/d20.html": None,
    "http://log.example/": log_page("one", "two") + "<a id=older href=2>o</a>",
    "http://log.example/2": log_page("three") + "<a id=older href=3>o</a>",
    "http://log.example/3": log_page("four"),
    "http://none.example/": "x",
}


def stored(store):
    rows = corpus_export(store.articles(), store.lookup("categories"), store.lookup("authors"), store.lookup("images")).collect()
    return {(r.domain, r.url): (r.title, r.body, r.category, r.author, r.featured_image, r.content_hash) for r in rows}


def checkpoints(store):
    return {r.domain: (r.last_url, r.last_page) for r in store.state().collect()}


def orders():
    urls = list(PAGES)
    backwards = sorted(urls, reverse=True)
    return {"two": [urls[::2], urls[1::2]], "five": [backwards[i::5] for i in (3, 1, 4, 0, 2)]}


@pytest.mark.parametrize("order", ["two", "five"])
def test_any_arrival_order(spark, sites, tmp_path, order, monkeypatch):
    whole = Store(spark, str(tmp_path / "whole"))
    expected = report(run(whole, sites, frame(spark, PAGES)))
    assert expected == {"rail": (7, 0, 3, 2), "log": (3, 0, 0, 0)}
    store = Store(spark, str(tmp_path / order))
    parsed = 0
    for i, urls in enumerate(orders()[order]):
        batch = frame(spark, {u: PAGES[u] for u in urls})
        if i == 1:  # a batch that ends before its commit changes nothing
            before = stored(store), checkpoints(store), report(Walk(store, sites, "w").report())
            with monkeypatch.context() as m:
                m.setattr(Run, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
                with pytest.raises(RuntimeError):
                    Walk(store, sites, "w").add(batch, f"w-{i}")
            assert (stored(store), checkpoints(store), report(Walk(store, sites, "w").report())) == before
            # what it parsed is kept
            assert Walk(store, sites, "w").add(batch, f"w-{i}") == 0
        else:
            parsed += Walk(store, sites, "w").add(batch, f"w-{i}")
        version = store.last_run()
        assert Walk(store, sites, "w").add(batch, f"w-{i}") == 0 and store.last_run() == version
    walk = Walk(store, sites, "w")
    walk.finish()
    walk.finish()
    assert report(walk.report()) == expected
    assert stored(store) == stored(whole) and checkpoints(store) == checkpoints(whole) == {"log.example": ("http://log.example/3", 3)}


def test_a_listing_that_came_too_early_waits(spark, sites, tmp_path):
    store, pages = Store(spark, str(tmp_path / "store")), rail_pages(3)
    add = lambda n, *names: Walk(store, sites, "w").add(frame(spark, {u: h for u, h in pages.items() if u.split("/")[-1] in names}), f"w-{n}")
    add(0, "p3.html", "d10.html", "d30.html")
    frontier = lambda: {r.site: (r.url, r.page_number, r.done) for r in store.of_walk("frontier", "w").collect()}
    assert frontier()["rail"] == ("http://rail.example/p1.html", 1, False) and stored(store) == {} and checkpoints(store) == {}
    add(1, "p1.html")
    assert frontier()["rail"] == ("http://rail.example/p2.html", 2, False) and len(stored(store)) == 1
    assert checkpoints(store) == {"rail.example": ("http://rail.example/p2.html", 2)}
    assert {r.item_url.split("/")[-1] for r in store.of_walk("waiting", "w").collect()} == {"d11.html", "about.html"}
    add(2, "p2.html", "about.html")
    assert frontier()["rail"][2] and checkpoints(store) == {}
    assert {u.split("/")[-1] for _, u in stored(store)} == {"d10.html", "d30.html", "about.html"}
    assert report(Walk(store, sites, "w").report()) == {"rail": (3, 0, 2, 0), "log": (0, 0, 0, 0)}
