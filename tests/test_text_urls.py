"""Text and URL functions against the standard library."""

import hashlib
import json
import re
import unicodedata
from urllib.parse import urljoin, urlparse

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from broadsheet.functions import text, urls


def slug_of(value):
    ascii_only = unicodedata.normalize("NFKD", value or "").encode("ascii", "ignore").decode()
    return re.sub("[^a-z0-9]+", "-", ascii_only.lower()).strip("-")


def one_column(spark, values, function):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["out"] for r in rows.select("i", function("v").alias("out")).orderBy("i").collect()]


def test_slugs(spark):
    values = ["Crème Brûlée: À la carte!!", "", None, "Plain Words 7", "Straße", "ﬁne ½ ㎏ Ⅷ", "--x--", "日本 tea", "𝐁old"]
    expected = ["creme-brulee-a-la-carte", "", "", "plain-words-7", "strae"]
    got = one_column(spark, values, text.slugify)
    assert got[:5] == expected
    assert got == [slug_of(v) for v in values]


def test_slug_of_every_character(spark):
    points = [chr(p) for p in range(1, 0x30000) if not 0xD800 <= p < 0xE000]
    values = ["".join(points[i : i + 50]) for i in range(0, len(points), 50)]
    assert one_column(spark, values, text.slugify) == [slug_of(v) for v in values]


def test_clean_text(spark):
    values = ["\t two  words \r\n\n here ", None, "", " a b\x1c　", "​a"]
    expected = ["two words here", "", "", "a b", "​a"]
    assert one_column(spark, values, text.clean_text) == expected
    assert expected == [re.sub(r"\s+", " ", v or "").strip() for v in values]


def test_content_hash_keeps_the_place_of_missing_parts(spark):
    rows = spark.createDataFrame([("t", None, "d"), ("t", "d", None), (None, None, None)], "a string, b string, c string")
    got = [r[0] for r in rows.select(text.content_hash("a", "b", "c")).collect()]
    joined = ["t␟␟d", "t␟d␟", "␟␟"]
    assert got == [hashlib.sha256(j.encode()).hexdigest() for j in joined]


def test_metadata_json(spark):
    maps = [{"tags": ["a", 'b "q" \\ é']}, {"one": ["x\n"]}, None, {}]
    rows = spark.createDataFrame([(m,) for m in maps], "m map<string, array<string>>")
    got = [r[0] for r in rows.select(text.metadata_json("m")).collect()]
    expected = [maps[0], {"one": "x\n"}, {}, {}]
    assert got == [json.dumps(e, ensure_ascii=False) for e in expected]


def test_falsy_coalescing(spark):
    row = spark.range(1).select(text.or_null(F.lit("")), text.or_default(F.lit(""), F.lit("d")), text.or_default(F.lit("x"), F.lit("d"))).first()
    assert tuple(row) == (None, "d", "x")


BASES = [
    "http://a/b/c/d;p?q", "http://a/b/c/d;p?q#f", "http://a", "http://a/", "https://h:80/x/y/", "http://a/b//c/d",
    "http://a/b/c/;p", "HTTP://A/b", "http://u@h/a/b?x=/y", "http://a/../b/./c",
]
REFERENCES = """g:h|g|./g|g/|/g|//g|?y|g?y|#s|g#s|g?y#s|;x|g;x|g;x?y#s||.|./|..|../|../g|../..|../../|../../g|../../../g
../../../../g|/./g|/../g|g.|.g|g..|..g|./../g|./g/.|g/./h|g/../h|g;x=1/./y|g;x=1/../y|g?y/./x|g#s/../x|http:g|http://q/w?
HTTP:g|https://z|g;|?|#|//h/p;|..;x|.;y|g//h|//g//h/../i|/a//b| g|mailto:x@y|javascript:void(0)|a b|é|/p?q=ü|g:|1:2|/..|/.
...|/a/...|;|http:///x|http:?y|http:#z|///x|////x|g/..//h|https://a/b""".replace("\n", "|").split("|")


def joined(spark, pairs):
    rows = spark.createDataFrame(pairs, "b string, r string")
    return [(r.b, r.r, r.j) for r in rows.select("b", "r", urls.url_join("b", "r").alias("j")).collect()]


def test_url_join(spark):
    pairs = [(b, r) for b in BASES for r in [*REFERENCES, "\tg", "g\nh"]]
    for base, ref, got in joined(spark, pairs):
        assert got == urljoin(base, ref), (base, ref)


segment = st.sampled_from(["a", "b;c", ".", "..", "", "x.html", "é", "~u"])
reference = st.builds(
    lambda lead, parts, query, fragment: lead + "/".join(parts) + query + fragment,
    st.sampled_from(["", "/", "//h.example/", "http://o.example/"]),
    st.lists(segment, max_size=5),
    st.sampled_from(["", "?q=1", "?a/../b"]),
    st.sampled_from(["", "#f", "#/.."]),
)


@settings(max_examples=5, deadline=None)
@given(st.lists(reference, min_size=80, max_size=80))
def test_url_join_on_generated_references(spark, references):
    pairs = [(base, r) for base in ("http://h/a/b/c", "https://h/a/b/?x#y", "http://h") for r in references]
    for base, ref, got in joined(spark, pairs):
        assert got == urljoin(base, ref), (base, ref)


def test_url_parts(spark):
    values = ["http://u:p@h.example:80/x", "https://h?x", "//h/x", "nothing", "http://h.example/#f"]
    assert one_column(spark, values, urls.url_host) == [urlparse(v).netloc for v in values]
    assert one_column(spark, values[:2], urls.url_origin) == ["http://u:p@h.example:80", "https://h"]
    assert one_column(spark, ["http://a/é"], urls.article_id) == [hashlib.sha256("http://a/é".encode()).hexdigest()[:16]]


def test_slug_falls_back_to_the_url(spark):
    rows = spark.createDataFrame([("", "http://h/p#item-0"), (None, "http://h/a/b-c.html"), ("T x", "u")], "t string, u string")
    assert [r[0] for r in rows.select(urls.article_slug("t", "u")).collect()] == ["p-item-0", "b-c-html", "t-x"]


def test_image_url(spark):
    rows = spark.createDataFrame([("http://h/a/b", i) for i in ("../i.png", "", None)], "u string, i string")
    assert [r[0] for r in rows.select(urls.image_url("u", "i")).collect()] == ["http://h/i.png", "", None]
