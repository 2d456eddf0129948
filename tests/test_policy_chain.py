"""Chains, checkpoints, policy, pacing and retries on small inputs, against plain loops."""

import random
from urllib.robotparser import RobotFileParser

import pytest
from pyspark.sql import functions as F

from broadsheet.operators.chain import cap_pages, page_chain
from broadsheet.operators.checkpoints import checkpoint_after_run, latest_checkpoint, reset_state, resolve_start
from broadsheet.operators.policy import fetch_outcomes, jitter_ms, politeness_plan, url_policy
from broadsheet.operators.reports import run_report, site_stats
from broadsheet.schemas import STATE


def walk(edges, start, page, cap):
    """Page numbers and URLs of one site; without a cap, up to the first URL seen before."""
    found, seen, url = [], set(), start
    while url in edges and not (not cap and url in seen):
        seen.add(url)
        found.append((page, url))
        following = edges[url]
        if not following or following == url or (cap and page >= cap):
            break
        url, page = following, page + 1
    return found


@pytest.mark.parametrize("site_pages", [10**6, 4, 0])
def test_chains(spark, site_pages):
    edges = {
        "line": {f"l{i}": f"l{i + 1}" if i < 11 else None for i in range(12)},
        "loop": {"a": "b", "b": "c", "c": "d", "d": "b"},
        "self": {"x": "x"},
        "gap": {"g0": "g1", "g1": "lost"},
        "none": {"n": None},
    }
    starts = [
        ("line", "l0", 1, None), ("loop", "a", 1, 0), ("self", "x", 1, None), ("gap", "g0", 1, None), ("none", "absent", 1, None),
        ("line2", "l0", 1, 2), ("line3", "l4", 5, 3), ("line4", "l3", 4, 9), ("loop2", "a", 1, 10),
    ]
    for copy, source in {"line2": "line", "line3": "line", "line4": "line", "loop2": "loop"}.items():
        edges[copy] = edges[source]
    rows = [(site, url, following) for site, links in edges.items() for url, following in links.items()]
    links = spark.createDataFrame(rows, "site string, url string, next_url string")
    begin = spark.createDataFrame(starts, "site string, start_url string, start_page int, max_pages int")
    expected = {(s, p, u) for s, start, page, cap in starts for p, u in walk(edges[s], start, page, cap)}
    got = page_chain(links, begin, site_pages=site_pages).collect()
    assert {(r.site, r.page_number, r.url) for r in got} == expected and len(got) == len(expected)
    next_of = {(r.site, r.page_number): r.next_url for r in got}
    assert next_of["line2", 2] == "l2"  # at the cap the next link is still known
    assert next_of["self", 1] is None
    overridden = page_chain(links, begin, max_pages=1, site_pages=site_pages).collect()
    assert {(r.site, r.page_number) for r in overridden} == {(s, p) for s, _, p, _ in starts if s != "none"}


@pytest.mark.parametrize("site_pages", [10**6, 0])
def test_pages_that_were_fetched_twice(spark, site_pages):
    rows = [("s", "a", "b"), ("s", "a", "c"), ("s", "b", "d"), ("s", "c", "d"), ("s", "d", None), (None, "a", "b"), ("s", None, "a")]
    links = spark.createDataFrame(rows, "site string, url string, next_url string")
    begin = spark.createDataFrame([("s", "a", 1, None), (None, "a", 1, None)], "site string, start_url string, start_page int, max_pages int")
    got = sorted((r.page_number, r.url, r.next_url or "") for r in page_chain(links, begin, site_pages=site_pages).collect())
    assert got == [(1, "a", "b"), (1, "a", "c"), (2, "b", "d"), (2, "c", "d"), (3, "d", "")]
    assert page_chain(links.limit(0), begin, site_pages=site_pages).collect() == []
    assert page_chain(links, begin.limit(0), site_pages=site_pages).collect() == []


def test_cap(spark):
    rows = spark.createDataFrame([(p, 4, cap) for p in (4, 5, 6) for cap in (None, 0, 2, 5)], "page_number int, start_page int, max_pages int")
    kept = {(r.page_number, r.max_pages) for r in cap_pages(rows).collect()}
    assert kept == {(4, None), (5, None), (6, None), (4, 0), (5, 0), (6, 0), (4, 2), (4, 5), (5, 5)}


def test_checkpoints(spark):
    ts = F.lit("2024-06-01").cast("timestamp")
    state = spark.createDataFrame([("a", "u2", 2, None), ("b", "", 7, None), ("c", "u9", 0, None), ("z", "u1", 1, None)], STATE)
    sites = spark.createDataFrame([(d, [f"{d}-first", "no"]) for d in "abcd"], "domain string, start_urls array<string>")
    starts = {r.domain: (r.start_url, r.start_page) for r in resolve_start(sites, state).collect()}
    assert starts == {"a": ("u2", 2), "b": ("b-first", 1), "c": ("u9", 1), "d": ("d-first", 1)}

    walked = [("a", 2, "u3", 1), ("a", 3, None, 2), ("c", 1, "u10", 3), ("d", 1, "p2", 1), ("d", 2, "p3", 2)]
    after = checkpoint_after_run(state, spark.createDataFrame(walked, "domain string, page_number int, next_url string, seq int"), ts)
    assert {r.domain: (r.last_url, r.last_page) for r in after.collect()} == {"b": ("", 7), "c": ("u10", 2), "z": ("u1", 1), "d": ("p3", 3)}
    writes = spark.createDataFrame([("a", "x", 1, 1), ("a", "y", 2, 5), ("a", "z", 3, 4)], "domain string, last_url string, last_page int, seq int")
    assert [tuple(r) for r in latest_checkpoint(writes).collect()] == [("a", "y", 2)]
    assert {r.domain for r in reset_state(state, sites).collect()} == {"z"}


ROBOTS = """
User-agent: sheet
User-agent: other
Disallow: /private/
Allow: /a%20b/open
Disallow: /a b/
Disallow: /q?x=1

User-agent: sheetbot
Disallow: /

User-agent: *
Disallow: /all
Disallow:
"""


def rules_of(lines):
    """Rows of one policy file, as the rules table holds them."""
    rows, agents, entry, rule, in_rules = [], [], 0, 0, False
    for line in lines.strip().splitlines():
        if ":" not in line:
            continue
        key, value = (x.strip() for x in line.split(":", 1))
        if key == "User-agent":
            if in_rules:
                agents, entry, in_rules = [], entry + 1, False
            agents.append(value)
        else:
            in_rules = True
            rows += [("http://h", entry, a, rule, value, key == "Allow") for a in agents]
            rule += 1
    return rows


@pytest.mark.parametrize("agent", ["SheetBot/1.0 (x)", "sheet", "Unknown/2", "another/1"])
def test_policy_equals_the_standard_parser(spark, agent):
    parser = RobotFileParser()
    parser.parse(ROBOTS.splitlines())
    paths = ["", "/", "/private/x", "/private", "/a%20b/open/1", "/a b/x", "/a%20b/x", "/q?x=1&y", "/q", "/all/x", "/ALL", "/é", "/+*~"]
    urls = [f"http://h{p}" for p in paths]
    rules = spark.createDataFrame(rules_of(ROBOTS), "origin string, entry_no int, agent string, rule_no int, path string, allow boolean")
    rows = spark.createDataFrame([(u,) for u in [*urls, "http://free/private/"]], "url string")
    got = {r.url: r.allowed for r in url_policy(rows, rules, agent).collect()}
    assert got == {**{u: parser.can_fetch(agent, u) for u in urls}, "http://free/private/": True}
    assert all(r.allowed for r in url_policy(rows, rules, agent, enabled=False).collect())


@pytest.mark.parametrize("rows_per_block", [10**6, 9])
def test_pacing_equals_a_loop(spark, rows_per_block):
    rng = random.Random(3)
    urls = [(f"http://{'hot' if rng.random() < 0.4 else f'h{rng.randrange(9)}'}/p{i}", i) for i in range(120)]
    rows = spark.createDataFrame(rng.sample(urls, len(urls)), "url string, seq bigint")
    jitters = {r.url: r.j for r in rows.select("url", jitter_ms(F.col("url"), F.lit(1.0)).alias("j")).collect()}
    assert all(0 <= j < 1000 for j in jitters.values()) and len(set(jitters.values())) > 50
    clock, expected = {}, {}
    for url, _ in urls:
        host = url.split("/")[2]
        clock[host] = clock[host] + 2000 + jitters[url] if host in clock else 0
        expected[url] = clock[host]
    plan = politeness_plan(rows, 2.0, 1.0, rows_per_block=rows_per_block).collect()
    assert {r.url: r.start_ms for r in plan} == expected
    assert {r.url for r in plan if r.gap_ms == 0} == {next(u for u, _ in urls if u.split("/")[2] == h) for h in clock}


def test_retries(spark):
    log = [
        ("ok", 1, 200, None), ("second", 1, 503, None), ("second", 2, 200, None), ("gone", 1, 404, None), ("gone", 2, 200, None),
        ("late", 1, 500, None), ("late", 2, None, "timeout"), ("late", 3, 429, None), ("late", 4, 200, None), ("odd", 1, None, "parse"), ("odd", 2, 200, None),
    ]
    rows = spark.createDataFrame(log, "url string, attempt int, status int, error string")
    outcomes = fetch_outcomes(rows, ["attempt"])
    assert {r.url: (r.fetch, r.attempts) for r in outcomes.collect()} == {
        "ok": ("ok", 1), "second": ("ok", 2), "gone": ("failed", 1), "late": ("failed", 3), "odd": ("failed", 1),
    }
    plan = outcomes._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_reports(spark):
    outcomes = spark.createDataFrame([("a", "inserted"), ("a", "skipped"), ("a", "error"), ("a", "odd")], "site string, outcome string")
    sites = spark.createDataFrame([("a",), ("b",)], "site string")
    report = {tuple(r) for r in run_report(sites, site_stats(outcomes)).collect()}
    assert report == {("a", 1, 0, 1, 1), ("b", 0, 0, 0, 0)}
