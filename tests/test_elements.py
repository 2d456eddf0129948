"""Elements as a table: selectors by joins and windows, compared with one page at a time."""

import json
import random

import pytest
from pyspark.sql import functions as F

from broadsheet.functions.markup import Page
from broadsheet.operators.elements import (
    articles_from_elements, element_table, first_below, links_from_elements, read_details, remove_elements, select_elements, with_html_key, with_text,
)
from broadsheet.operators.extract import extract_articles, list_items

SELECTORS = [
    "p", "*", ".a", "p.a", "#x", "[k]", "[k=v]", "div p", "div > p", "p + p", "p ~ b", "b, .a", "div div > b", "div > div p + b", "p:nth-child(2)", "div:nth-child(1) > .a ~ p",
    "ul > li > b", "ul li:nth-child(2), div > .c", "table td", "li b ~ b",
]
NOISE = ["script", ".c", "p:nth-child(1)", "b + b", "ul", "p:nth-child(1)"]


def random_page(seed):
    rng = random.Random(seed)

    def piece(depth):
        if depth == 0 or rng.random() < 0.2:
            return rng.choice(["one", " two\n three ", "&amp;", "", "<br>", "<script>x < y</script>", "<rt>r</rt>"])
        tag = rng.choice(["div", "p", "b", "ul", "li", "div"])
        attrs = rng.choice(["", " class=a", ' class="c a"', " id=x", ' k="v"', " k", " class=c"])
        inner = "".join(piece(depth - 1) for _ in range(rng.randint(0, 4)))
        return f"<{tag}{attrs}>{inner}" + ("" if rng.random() < 0.1 else f"</{tag}>")

    return "loose text" * (seed % 2) + "".join(piece(5) for _ in range(4))


HTML = [random_page(i) for i in range(25)] + ["", "no element", "<p>", "<div>" * 300 + "deep", random_page(0), "<ul>" + "<li><b>i</b><b>j</b>" * 2000 + "</ul>"]


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, f"http://h/{i}", h, "clash", "clash") for i, h in enumerate([*HTML, None])]
    return spark.createDataFrame(rows, "page_id long, url string, html string, node string, name string").repartition(3)


@pytest.fixture(scope="module")
def table(pages):
    return element_table(pages)


def by_page(pages, found, *columns):
    """page_id and name to the rows found, in the order of the document."""
    out = {}
    keys = with_html_key(pages).select("html_key", "page_id")
    for r in found.join(keys, "html_key").orderBy("node").collect():
        out.setdefault((r.page_id, r["name"]), []).append(tuple(r[c] for c in columns))
    return out


def test_elements_once_per_html(table):
    nodes = table.where("node IS NOT NULL").groupBy("html_key").agg(F.count("*").alias("n"), F.countDistinct("node").alias("d"), F.max("node").alias("m"))
    assert all(r.n == r.d == r.m + 1 for r in nodes.collect())
    assert table.select("html_key").distinct().count() == len(set(HTML))
    assert table.where("node IS NULL").count() == 2  # '' and text alone


def test_selectors_and_text(spark, pages, table):
    got = by_page(pages, with_text(table, select_elements(table, {s: s for s in SELECTORS})), "node", "text")
    for i, html in enumerate(HTML):
        page = Page(html)
        for s in SELECTORS:
            assert got.get((i, s), []) == [(e, page.text(e)) for e in page.select(None, s)], (html, s)
    assert not any(i == len(HTML) for i, _ in got)


def test_removed_in_turn(pages, table):
    left = remove_elements(table, NOISE)
    asked = {s: s for s in SELECTORS}
    got = by_page(pages, with_text(left, select_elements(left, asked)), "node", "text")
    assert by_page(pages, select_elements(table, asked, NOISE, text=True), "node", "text") == got
    for i, html in enumerate(HTML):
        page = Page(html)
        for s in NOISE:
            page.remove(None, s)
        for s in SELECTORS:
            assert got.get((i, s), []) == [(e, page.text(e)) for e in page.select(None, s)], (html, s)


def test_first_below(pages, table):
    found = select_elements(table, {"scope": "div", "inner": ".a, div"})
    first = first_below(found.where("name = 'scope'"), found.where("name = 'inner'"), F.col("tag")).withColumn("name", F.lit("x"))
    got = by_page(pages, first, "node", "value")
    for i, html in enumerate(HTML):
        page = Page(html)
        below = [(e, page.select(e, ".a, div")) for e in page.select(None, "div")]
        assert got.get((i, "x"), []) == [(e, page.tag[b[0]] if b else None) for e, b in below]


def test_details_and_links(spark, pages, table):
    config = {
        "list_page": {"item_selector": "li, div", "link_selector": "[k]", "link_attr": "k"},
        "article": {
            "title_selector": "div > b", "body_selector": "div", "author_selector": None, "published_at_selector": "[k]", "published_at_attr": "k", "category_selector": "table",
            "featured_image_selector": "#x", "featured_image_attr": "id", "remove_selectors": ["script", "p + p"], "metadata_selectors": {"cs": ".c", "none": "table", "as": ".a"},
        },
    }
    key = lambda rows: sorted(json.dumps(r.asDict(), sort_keys=True, default=str) for r in rows)
    pages = pages.drop("name")
    assert key(articles_from_elements(pages, table, config).collect()) == key(extract_articles(pages, config).collect())
    columns = ["page_id", "page_url", "item_idx", "mode", "item_url"]
    assert key(links_from_elements(pages, table, config).select(columns).collect()) == key(list_items(pages, config).select(columns).collect())
    itself = {"list_page": {"item_selector": "[k]", "link_attr": "k"}}
    assert key(links_from_elements(pages, table, itself).select(columns).collect()) == key(list_items(pages, itself).select(columns).collect())
    with pytest.raises(ValueError):
        select_elements(table, {"x": "p:hover"})


def test_empty_table(pages):
    nothing = element_table(pages.limit(0))
    assert nothing.collect() == []
    assert select_elements(remove_elements(nothing, ["p"]), {"x": "div > p"}).collect() == []
    assert select_elements(nothing, {"x": "div > p"}, ["p"], text=True).collect() == []
    assert read_details(nothing, {"article": {"title_selector": "p"}}).collect() == []


def test_no_python_and_one_exchange_of_elements(table):
    """Selectors of any number share their windows: one shuffle by page, one more per kind of family step."""
    plan = lambda selectors: select_elements(table, {s: s for s in selectors})._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan(SELECTORS) and "Arrow" not in plan(SELECTORS)
    assert plan(["div p", "ul b", "div .a, div .c"]).count("hashpartitioning(html_key") == plan(["div p"]).count("hashpartitioning(html_key")
