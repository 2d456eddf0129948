"""Page table, selectors and the extraction UDF on small pages of our own."""

import json
import random
import time
import tracemalloc
from html.parser import HTMLParser

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from broadsheet.functions import html as html_functions
from broadsheet.functions.html import _detail, _listing, check_config, detail, listing
from broadsheet.functions.markup import Page, parse_selector

EVENTS = {
    "list_page": {"item_selector": "table.calendar tr[data-event]", "link_selector": "td.what > a"},
    "pagination": {"enabled": True, "next_selector": "caption a.later"},
}
CALENDAR = """<table class="calendar"><caption>May <a class="later" href="?month=6">June</a></caption>
<tr><th>Day</th><th>What</th></tr>
<tr data-event=17><td>3</td><td class="what"><b>free</b> <a href="concert/17">Concert</a></td></tr>
<tr data-event=18><td>9</td><td class="what">Cancelled</td></tr>
<tr data-event=19><td>21</td><td class="what"><a href="//tickets.example/19">Fair</a></td></tr></table>"""
THREAD = {
    "list_page": {"item_selector": "#thread > section", "item_is_article": True},
    "pagination": {"enabled": True, "next_selector": "form a[rel=next]"},
    "article": {"title_selector": "h4", "body_selector": "div.says", "author_selector": "h4 + span", "remove_selectors": ["form", "s"],
                "metadata_selectors": {"badges": "i.badge", "struck": "s"}},
}
POSTS = """<div id="thread">
<section><h4>Which glue?</h4><span>mira</span><i class="badge">old hand</i><i class="badge gold"></i><div class="says">Any <s>cheap</s> wood glue.</div></section>
<section><h4></h4><span>tom</span><div class="says">Bone glue.<form>reply</form></div></section>
</div><form><a rel="next" href="/t/9?p=2">older</a></form>"""


def texts(html, selector):
    page = Page(html)
    return [page.text(e) for e in page.select(None, selector)]


def detail_of(html, **article):
    return _detail(html, {"article": article})


def test_fields_are_cleaned_text():
    html = "<dl><dt>Speaker<dd>Dr.&nbsp;<em>Ana</em>\n  Ruiz<dt>Room<dd>4<br>B</dl>"
    got = detail_of(html, author_selector="dd", body_selector="dd:nth-child(4)", title_selector="h1", category_selector=None)
    assert (got["author"], got["body"], got["title"], got["category"]) == ("Dr. Ana Ruiz", "4 B", None, None)


def test_attributes_are_taken_as_they_are():
    html = '<img id=map src="../../maps/ hall.png"><abbr class="starts" title="">soon</abbr>'
    got = detail_of(html, featured_image_selector="#map", published_at_selector="abbr.starts", published_at_attr="title")
    assert (got["featured_image"], got["published_at"]) == ("../../maps/ hall.png", "")


def test_body_may_be_a_following_sibling():
    assert detail_of("<h3 id=notes>Notes</h3><hr><blockquote>Bring a cup.</blockquote>", body_selector="#notes ~ blockquote")["body"] == "Bring a cup."


def test_noise_is_removed_before_fields_are_read():
    html = "<nav><h1>Menu</h1></nav><main><h1>Talk</h1><p>Good.<script>var end = '</p>bad';</script></p><!-- gone --></main>"
    got = detail_of(html, title_selector="h1", body_selector="main p", remove_selectors=["nav", "script"])
    assert (got["title"], got["body"]) == ("Talk", "Good.")


def test_metadata_takes_all_matches():
    html = "<ul class=facts><li>price &euro;3</li><li class='seats few'></li><li>\n outdoors </li></ul>"
    got = detail_of(html, metadata_selectors={"facts": ".facts li", "absent": "ol"})
    assert dict(got["metadata"]) == {"facts": ["price €3", "seats few", "outdoors"]}  # classes stand in for an empty element


def test_listing_of_links():
    got = _listing(CALENDAR, EVENTS)
    assert got["next_href"] == "?month=6"
    assert [(i["idx"], i["href"]) for i in got["items"]] == [(0, "concert/17"), (1, None), (2, "//tickets.example/19")]


def test_listing_of_inline_articles():
    got = _listing(POSTS, THREAD)
    first, second = (i["article"] for i in got["items"])
    assert got["next_href"] == "/t/9?p=2"  # noise removal does not reach the next link
    assert (first["title"], first["body"], first["author"]) == ("Which glue?", "Any wood glue.", "mira")
    assert dict(first["metadata"]) == {"badges": ["old hand", "badge gold"]}
    assert (second["title"], second["body"], second["author"], dict(second["metadata"])) == (None, "Bone glue.", "tom", {})


def test_paging_can_be_off():
    assert _listing(CALENDAR, {**EVENTS, "pagination": {"enabled": False}})["next_href"] is None
    assert _listing(CALENDAR, {"list_page": {"item_selector": "td a"}})["items"][0]["href"] == "concert/17"


def test_image_attribute_default_depends_on_the_key():
    html = '<img src="s.png"><figure>text</figure>'
    assert _detail(html, {"article": {"featured_image_selector": "img"}})["featured_image"] == "s.png"
    assert _detail(html, {"article": {"featured_image_selector": "figure", "featured_image_attr": None}})["featured_image"] == "text"


@pytest.mark.parametrize("selector, expected", [
    ("p", ["a", "b", "c", "d"]), ("div p", ["b", "c"]), ("div > p", ["b"]), ("#m", ["b"]), ("p.x", ["b", "d"]), (".x.y", ["d"]),
    ("[data-k]", ["a", "c"]), ('[data-k="2"]', ["c"]), ("h2 + p", ["d"]), ("h2 ~ p", ["d"]), ("p:nth-child(1)", ["a", "b", "c"]),
    ("h2, p.x", ["b", "H", "d"]), ("section *", ["c"]), ("div>section  p", ["c"]), ("p p", []),
])
def test_selectors(selector, expected):
    html = ("<p data-k=1>a</p><div><p id=m class='x'>b</p><section><p data-k='2'>c</p></section></div>"
            "<h2>H</h2><p class='y  x z'>d</p>")
    assert texts(html, selector) == expected


@pytest.mark.parametrize("selector", ["p:hover", "a >", "> a", "p:nth-child(2n)", "[a^=b]", "a,,b", ""])
def test_unsupported_selectors_raise(selector):
    with pytest.raises(ValueError):
        parse_selector(selector)


def test_configs_are_checked_on_the_driver():
    with pytest.raises(ValueError):
        check_config({"article": {"title_selector": "p:hover"}})
    with pytest.raises(ValueError):
        check_config({"article": {"metadata_selectors": {"k": "p::x"}}})
    check_config({**EVENTS, "list_page": {"item_selector": "li", "wait_for_selector": "p:hover"}}, "listing")
    for config, use in ((EVENTS, "detail"), ({"list_page": {}}, "listing"), ({}, "listing"), ({**THREAD, "article": None}, "listing"), ("text", "detail")):
        with pytest.raises(ValueError):
            check_config(config, use)
    with pytest.raises(ValueError):
        check_config({**EVENTS, "pagination": {"enabled": True}}, "listing")


def test_implied_ends_and_strays():
    assert texts("<p>a<p>b<div>c</div>d", "p") == ["a", "b"]
    assert texts("<ul><li>a<ul><li>b</ul><li>c</ul>", "li") == ["a b", "b", "c"]
    assert texts("<table><tr><td>a<td>b<tr><td>c</table>", "td") == ["a", "b", "c"]
    assert texts("<div><p><b>x<br><p>y</b></div>z", "p") == ["x", "y"]
    assert texts("</div><div>a</span></div>", "div") == ["a"]
    assert texts("<b>a<div></b>c</div>", "div") == ["c"]


def test_strings_that_do_not_count():
    html = "<div>a<script>s</script><style>t</style><template>u</template><!-- v --><ruby>w<rt>x</rt></ruby></div>"
    assert texts(html, "div") == ["a w"]
    assert texts(html, "script") == ["s"]


def test_selectors_look_at_ancestors_outside_the_scope():
    page = Page("<main><div class=q><p>a</p></div></main>")
    scope = page.select(None, "div.q")[0]
    assert [page.text(e) for e in page.select(scope, "main p")] == ["a"]
    assert page.select(scope, "div.q") == []


def test_removal_renumbers_siblings():
    page = Page("<ul><li>a</li><li class=ad>b</li><li>c</li></ul>")
    assert [page.text(e) for e in page.select(None, "li:nth-child(2)")] == ["b"]
    page.remove(None, ".ad")
    assert [page.text(e) for e in page.select(None, "li:nth-child(2)")] == ["c"]
    assert page.text(page.select(None, "ul")[0]) == "a c"


def test_attributes():
    page = Page("""<a href='x"y' HREF=z title="a > b" data-a=1 empty class="p  q" x=it's>t</a>""")
    assert page.attrs(0) == {"href": 'x"y', "title": "a > b", "data-a": "1", "empty": "", "class": "p  q", "x": "it's"}
    assert page.text(0) == "t"


class Strings(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found, self.raw = [], None

    def handle_starttag(self, tag, attrs):
        self.raw = tag if tag in ("script", "style") else None

    def handle_endtag(self, tag):
        self.raw = None

    def handle_data(self, data):
        if self.raw is None and data.strip():
            self.found.append(data.strip())


def test_text_agrees_with_the_standard_parser_on_all_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").toPandas()
    for html in pages["html"]:
        parser = Strings()
        parser.feed(html)
        page = Page(html)
        assert page.text(0).split() == " ".join(parser.found).split()


def test_udf_reports_errors_as_rows(spark):
    rows = spark.createDataFrame([("<h1>a</h1>",), (None,)], "html string")
    broken = {"article": {"title_selector": "h1", "metadata_selectors": {"k": 5}}}
    got = rows.select(detail("html", {"article": {"title_selector": "h1"}}).alias("d")).collect()
    assert got[0].d.title == "a" and got[0].d.error is None
    assert got[1].d.error and got[1].d.title is None  # no page is a failed fetch, not an empty one
    got = rows.select(detail("html", F.lit(json.dumps(broken))).alias("d"), listing("html", F.lit("{}")).alias("l")).collect()
    assert got[0].d.title is None and got[0].d.error
    assert "list_page" in got[0].l.error
    assert rows.select(detail("html", F.lit("no json")).alias("d")).first().d.error


@pytest.mark.parametrize("piece", ['<a b="', "<a ", "<!--", "<!", "<b><p>", "<a b='\"", "<div ", "</a"])
def test_hostile_pages_take_linear_time(piece):
    for html in (piece * (500_000 // len(piece)), piece * (500_000 // len(piece)) + "'\">x"):
        start = time.process_time()
        Page(html)
        assert time.process_time() - start < 8


def test_text_after_an_unfinished_tag_stays():
    assert texts("<p>a <b>c</b> 1 < 2 <i", "p") == ["a c 1 < 2 < i"]


def test_tags_that_never_end_hide_nothing_else(monkeypatch):
    """Every tag that the pattern finds is found, however many before it have no end."""
    rng = random.Random(8)
    pages = ["".join(rng.choice(['<a x="', "<b y='", "<i>", "</i>", '">', "'>", "=", '"', "'", " t ", "<p z=1>", "<!--", "-->", "< ", "</b", "<u =>"]) for _ in range(rng.randint(1, 60))) for _ in range(400)]
    pages.append('<a x="1\' y=\'>"' * 30 + "'\"><h1>seen</h1>" + '<a x="' * 40)
    read = lambda html: (lambda p: (p.tag, p.raw_attrs, p.parent, p.texts, p.text_owner))(Page(html))
    quick = [read(h) for h in pages]
    assert any(t.count("<") > 17 for _, _, _, t, _ in quick)
    monkeypatch.setattr("broadsheet.functions.markup.TagEnds.found", lambda self, at: True)
    assert quick == [read(h) for h in pages]
    assert "h1" in quick[-1][0]


@pytest.mark.parametrize("several", [False, True])
def test_a_batch_is_read_piece_by_piece(monkeypatch, several):
    """Of a large batch only few pages at a time are Python objects."""
    config = {"article": {"title_selector": "h1", "body_selector": "p"}}
    pages = pa.array([None if i % 100 == 7 else f"<h1>{i}</h1><p>{'x' * 10_000}</p>" for i in range(3000)], pa.string())
    configs = pa.array([json.dumps(config)] * len(pages))
    monkeypatch.setattr(html_functions, "_col", lambda c: c)
    monkeypatch.setattr(html_functions.F, "arrow_udf", lambda function, schema: lambda *columns: function)
    function = html_functions.detail("html", "config" if several else config)
    tracemalloc.start()
    try:
        n = 0
        for out in function(iter([(pages, configs), (pages[:0], configs[:0])] if several else [pages, pages[:0]])):
            for title in out.field("title").to_pylist():
                assert title == (None if n % 100 == 7 else str(n))
                n += 1
        assert n == len(pages) and tracemalloc.get_traced_memory()[1] < 16 << 20
    finally:
        tracemalloc.stop()
