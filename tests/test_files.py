"""Policy files, pages as bytes, and attempts that arrive in any order."""

import random
from urllib.robotparser import RobotFileParser

import pytest
from pyspark.sql import functions as F

from broadsheet.operators.policy import chosen_rules, fetch_outcomes, policy_rules, url_policy
from broadsheet.sources.pages import read_html_files, with_html
from broadsheet.streaming.retries import OUTCOMES, latest_outcomes, stream_fetch_outcomes

PATHS = ["", "/", "/a", "/a/b", "/a%20b/c", "/a b", "/b?x=1", "/é", "/B", "/a/bc/d", "/+*~", "//a"]


def generated(rng):
    """A policy file of odd lines in any order."""
    lines = []
    for _ in range(rng.randint(0, 14)):
        field = rng.choice(["User-agent", "user-AGENT ", "Disallow", "Allow", "allow", "Crawl-delay", "Request-rate", "Sitemap", "Host", "nonsense"])
        value = rng.choice(["*", "sheet", "SheetBot", "other", "%73heet"]) if field.lower().startswith("user") else rng.choice([*PATHS, "3", "1/5", "/%61", "/A"])
        lines.append(rng.choice([f"{field}: {value}", f"{field}:{value}  # why", f"  {field} : {value}\t", "", "# only this", "   ", field, f"{field}: {value}"]))
    return rng.choice(["\n", "\r\n"]).join(lines)


def test_policy_files_equal_the_standard_parser(spark):
    rng = random.Random(11)
    files = {f"http://h{i}.example": generated(rng) for i in range(150)}
    pages = spark.createDataFrame([(f"{o}/robots.txt", t) for o, t in files.items()] + [("http://h0.example/a/robots.txt", "User-agent: *\nDisallow: /"), ("http://none/robots.txt", None)], "url string, html string")
    rules = policy_rules(pages).cache()
    urls = spark.createDataFrame([(f"{o}{p}",) for o in files for p in PATHS], "url string")
    for agent in ("SheetBot/1.0 (x)", "unknown"):
        expected = {}
        for origin, text in files.items():
            parser = RobotFileParser()
            parser.parse(text.splitlines())
            parser.modified()
            expected |= {f"{origin}{p}": parser.can_fetch(agent, f"{origin}{p}") for p in PATHS}
        assert len(set(expected.values())) == 2
        for few in (200, 0):
            got = {r.url: r.allowed for r in url_policy(urls, rules, agent, few_rules=few).collect()}
            assert got == expected


def test_very_many_rules_on_one_origin(spark):
    number = F.col("id")
    path = F.concat(F.lit("/"), F.substring(F.md5(number.cast("string")), 1, 6), F.when(number % 3 == 0, "/x").otherwise(""))
    rules = spark.range(50_000).select(F.lit("http://h").alias("origin"), F.lit(0).alias("entry_no"), F.lit("*").alias("agent"), number.cast("int").alias("rule_no"), path.alias("path"), (number % 2 == 0).alias("allow"))
    urls = spark.range(3000).select(F.concat(F.lit("http://h/"), F.substring(F.md5((number * 20).cast("string")), 1, 6), F.lit("/x/"), number).alias("url"))
    first = {}
    for r in sorted(rules.collect(), key=lambda r: r.rule_no):
        first.setdefault(r.path, (r.rule_no, r.allow))
    out = url_policy(urls, rules, "bot")
    for r in out.collect():
        path = r.url.removeprefix("http://h")
        hits = [first[p] for p in (path[:7], path[:9]) if p in first]
        assert r.allowed == (min(hits)[1] if hits else True)
    # no row holds the rules, and no row is made per URL and rule
    assert chosen_rules(rules, "bot").groupBy("origin").count().first()["count"] == len(first)
    assert "rules" not in out.columns and out.count() == 3000


@pytest.mark.parametrize(
    "content, header, text",
    [
        ("é€".encode(), None, "é€"), (b"\xef\xbb\xbf" + "é".encode(), "text/html; charset=latin1", "é"), (b"a\xffb", None, "a�b"),
        ("Привет".encode("utf-16"), None, "Привет"), (b"\xfe\xff" + "é𝒜".encode("utf-16-be"), None, "é𝒜"), (b"\xff\xfe\x3d\xd8a", None, b"\x3d\xd8a".decode("utf-16-le", "replace")),
        ("é€".encode("cp1252"), "text/html; Charset=Windows-1252", "é€"), (b'<meta charset="ISO-8859-1">\xe9\x80', None, '<meta charset="ISO-8859-1">é€'),
        ("<meta http-equiv=x content='text/html; charset=koi8-r'>Да".encode("koi8-r"), None, "<meta http-equiv=x content='text/html; charset=koi8-r'>Да"),
        ("日本".encode("shift_jis"), "text/html;charset=shift_jis", "日本"), ("é".encode(), "text/html; charset=no-such", "é"), (b"", None, ""), (None, None, None),
        (b"<meta charset=latin1>\xe9", "text/html; charset=utf-8", "<meta charset=latin1>�"),
    ],
)
def test_charsets(spark, content, header, text):
    got = with_html(spark.createDataFrame([(content, header)], "content binary, type string"), header="type").collect()
    assert [(r.html,) for r in got] == [(text,)] and got[0].asDict().keys() == {"html"}


def test_saved_files_have_their_own_charsets(spark, tmp_path):
    (tmp_path / "a.html").write_bytes("<p>ü".encode("utf-16"))
    (tmp_path / "b.html").write_bytes("<meta charset=windows-1252><p>ü“".encode("cp1252"))
    got = {r.url: r.html for r in read_html_files(spark, str(tmp_path), "http://h").collect()}
    assert got == {"http://h/a.html": "<p>ü", "http://h/b.html": "<meta charset=windows-1252><p>ü“"}
    assert {r.html for r in read_html_files(spark, str(tmp_path), "http://h", "UTF-16LE").where("url LIKE '%a.html'").collect()} == {"﻿<p>ü"}


@pytest.mark.parametrize("seed", [1, 2])
def test_late_attempts_in_any_order(spark, tmp_path, seed):
    rng = random.Random(seed)
    kinds = [(200, None), (404, None), (503, None), (429, None), (None, "timeout"), (None, "parse")]
    log = [(f"u{rng.randrange(25)}", *rng.choice(kinds), i) for i in range(120)]
    schema = "url string, status int, error string, at long"
    parts = [[] for _ in range(3)]
    for row in log:
        rng.choice(parts).append(row)
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
        arrived = spark.readStream.schema(schema).parquet(str(tmp_path / "log"))
        stream_fetch_outcomes(arrived, [F.col("at")], str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    expected = {tuple(r) for r in fetch_outcomes(spark.createDataFrame(log, schema), ["at"]).collect()}
    assert {tuple(r) for r in latest_outcomes(spark, str(tmp_path / "out")).collect()} == expected
    told = spark.read.schema(OUTCOMES).parquet(str(tmp_path / "out")).collect()
    # a revision says something new, and what is final is told again only when an earlier attempt changed it
    by_url = {}
    for r in sorted(told, key=lambda r: r.revision):
        by_url.setdefault(r.url, []).append((r.fetch, r.attempts, r.status, r.final))
        assert r.revision == len(by_url[r.url])
    assert all(a != b for rows in by_url.values() for a, b in zip(rows, rows[1:])) and max(map(len, by_url.values())) > 1


def test_late_attempts_of_a_repeated_batch(spark, tmp_path):
    """Outcomes are settled without Python on the executors; a batch whose commit was lost is done again, and attempts without a place come first."""
    rows = [("u1", 503, None, 5), ("u1", 200, None, 7), ("u2", 404, None, 1), ("u1", 429, None, 3), ("u1", 503, None, 4), (None, 200, None, 2), ("u2", 200, None, None)]
    schema, log, query = "url string, status int, error string, at long", str(tmp_path / "log"), None
    for i, part in enumerate((rows[:3], rows[3:6], rows[6:])):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(log)
        arrived = spark.readStream.schema(schema).parquet(log)
        query = stream_fetch_outcomes(arrived, [F.col("at")], str(tmp_path / "out"), str(tmp_path / "checkpoint"))
        query.awaitTermination()
        assert query.lastProgress["stateOperators"] == []
        if i == 1:
            (tmp_path / "checkpoint" / "commits" / "1").unlink()
            (tmp_path / "checkpoint" / "commits" / ".1.crc").unlink(missing_ok=True)
    told = sorted(spark.read.schema(OUTCOMES).parquet(str(tmp_path / "out")).collect(), key=lambda r: (r.url or "", r.revision))
    assert [tuple(r)[:6] for r in told] == [
        (None, "ok", 1, 200, True, 1),
        ("u1", "ok", 2, 200, True, 1), ("u1", "failed", 3, 503, True, 2),
        ("u2", "failed", 1, 404, True, 1), ("u2", "ok", 1, 200, True, 2),
    ]
    expected = {tuple(r) for r in fetch_outcomes(spark.createDataFrame(rows, schema), ["at"]).collect()}
    assert {tuple(r) for r in latest_outcomes(spark, str(tmp_path / "out")).collect()} == expected
