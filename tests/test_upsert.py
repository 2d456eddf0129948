"""Upsert, lookups and skew handling against a sequential replay."""

import random

import pytest
from pyspark.sql import functions as F

from broadsheet.operators.lookups import attach_lookup_ids, merge_lookups, new_lookups
from broadsheet.operators.skew import split_hot, with_blocks
from broadsheet.operators.upsert import (
    item_route, known_items, match_existing, skip_known, upsert_outcomes, upsert_snapshot, written_rows,
)

EVENT = "domain string, article_id string, seq bigint, mode string, fetch string, content_hash string"
STORED = "domain string, article_id string, content_hash string, title string, scraped_at string, updated_at string"


def replay(events, stored, force):
    """The outcomes, one event after another."""
    table = {(d, a): h for d, a, h, *_ in stored}
    owner = {a: d for d, a in table}
    out = {}
    for domain, article, seq, mode, fetch, digest in sorted(events, key=lambda e: e[2]):
        key = (domain, article)
        if mode == "link" and not force and key in table:
            out[seq] = ("skipped", "known")
        elif fetch == "denied":
            out[seq] = ("skipped", "denied")
        elif fetch == "failed":
            out[seq] = ("error", "fetch")
        elif key not in table and owner.get(article, domain) != domain:
            out[seq] = ("error", "url_conflict")
        elif key not in table:
            table[key], owner[article] = digest, domain
            out[seq] = ("inserted", "new")
        elif table[key] == digest:
            out[seq] = ("skipped", "unchanged")
        else:
            table[key] = digest
            out[seq] = ("updated", "changed")
    return out, table


def random_events(seed, n=400):
    rng = random.Random(seed)
    events = []
    for seq in range(n):
        # One article holds a third of all events.
        article = "hot" if rng.random() < 0.33 else f"a{rng.randrange(25)}"
        mode = rng.choice(["link", "inline"])
        fetch = "ok" if mode == "inline" else rng.choice(["ok", "ok", "denied", "failed"])
        events.append((rng.choice(["x", "x", "y", "z"]), article, seq, mode, fetch, rng.choice(["h1", "h2", None])))
    rng.shuffle(events)
    stored = [(rng.choice("xy"), f"a{i}", rng.choice(["h1", "h2", None]), f"old{i}", "t0", "t0") for i in range(0, 30, 3)]
    if seed % 2:
        stored.append(("y", "hot", "h1", "old", "t0", "t0"))
    return events, stored


@pytest.mark.parametrize("seed, force, hot_rows", [(1, False, 10**6), (2, True, 10**6), (3, False, 20), (4, True, 20), (5, True, 7), (6, False, 7)])
def test_outcomes_equal_a_sequential_replay(spark, seed, force, hot_rows):
    events, stored = random_events(seed)
    staged = spark.createDataFrame(events, EVENT)
    articles = spark.createDataFrame(stored, STORED)
    outcomes = upsert_outcomes(staged, articles, force, hot_rows)
    expected, table = replay(events, stored, force)
    got = {r.seq: (r.outcome, r.reason) for r in outcomes.collect()}
    assert got == expected

    content = staged.withColumn("title", F.concat(F.lit("new"), "seq"))
    written = written_rows(outcomes, content.select("domain", "article_id", "seq", "title", "content_hash"), articles, F.lit("t1"))
    snapshot = upsert_snapshot(articles, written).collect()
    assert {(r.domain, r.article_id): r.content_hash for r in snapshot} == table
    assert len(snapshot) == len(table)
    before = {(d, a) for d, a, *_ in stored}
    for r in snapshot:
        key = (r.domain, r.article_id)
        touched = any(expected[e[2]][0] in ("inserted", "updated") for e in events if e[:2] == key)
        assert r.scraped_at == ("t0" if key in before else "t1")
        assert r.updated_at == ("t1" if touched else "t0")


def test_struct_order(spark):
    rows = [("d", "a", (1, 2, 0), "inline", "ok", "h1"), ("d", "a", (1, 1, 5), "inline", "ok", "h2"), ("d", "a", (0, 9, 9), "inline", "ok", "h1")]
    schema = EVENT.replace("seq bigint", "seq struct<site_order: bigint, page_number: bigint, item_idx: bigint>")
    staged = spark.createDataFrame(rows, schema)
    for hot_rows in (100, 1):
        outcomes = upsert_outcomes(staged, spark.createDataFrame([], STORED), hot_rows=hot_rows)
        got = [r.outcome for r in outcomes.orderBy("seq").collect()]
        assert got == ["inserted", "updated", "updated"]


def test_blocks_follow_any_order(spark):
    """Epoch milliseconds below site numbers of a second partition: blocks of any size give the same."""
    seq = "struct<site_order: bigint, page_number: bigint, item_idx: bigint>"
    rng = random.Random(8)
    rows = [("d", "a", (rng.choice([0, 2**33, 2**34]), 1_700_000_000_000 + i, i % 3), "inline", "ok", rng.choice(["h1", "h2"])) for i in range(60)]
    staged = spark.createDataFrame(rows, EVENT.replace("seq bigint", f"seq {seq}"))
    empty = spark.createDataFrame([], STORED)
    got = [upsert_outcomes(staged, empty, hot_rows=n).orderBy("seq").select("seq", "outcome").collect() for n in (10**6, 3)]
    assert got[0] == got[1]
    names = staged.select("domain", F.concat(F.lit("n"), "seq.page_number").alias("name"), "seq")
    lookup = spark.createDataFrame([], "id bigint, domain string, name string")
    ids = [new_lookups(names, lookup, rows_per_block=n).orderBy("id").collect() for n in (10**6, 3)]
    assert ids[0] == ids[1] and [r.name for r in ids[0]] == [f"n{r[2][1]}" for r in sorted(rows, key=lambda r: r[2])]


def test_unchanged_and_case_of_columns_outside_the_hash(spark):
    staged = spark.createDataFrame([("d", "a", 1, "inline", "ok", "h")], EVENT)
    articles = spark.createDataFrame([("d", "a", "h", "kept", "t0", "t0")], STORED)
    outcomes = upsert_outcomes(staged, articles)
    assert outcomes.first().reason == "unchanged"
    content = staged.select("domain", "article_id", "seq", F.lit("ignored").alias("title"), "content_hash")
    snapshot = upsert_snapshot(articles, written_rows(outcomes, content, articles, F.lit("t1")))
    assert [tuple(r) for r in snapshot.collect()] == [("d", "a", "h", "kept", "t0", "t0")]


def test_known_items(spark):
    rows = [("d", "a", 1, "link", "ok", "h"), ("d", "a", 2, "inline", "ok", "h"), ("e", "a", 3, "link", "ok", "h")]
    items = spark.createDataFrame(rows, EVENT)
    articles = spark.createDataFrame([("d", "a", None, "t", "t0", "t0")], STORED)
    assert {r.seq for r in skip_known(items, articles).collect()} == {2, 3}
    assert {r.seq for r in skip_known(items, articles, force=True).collect()} == {1, 2, 3}
    assert {r.seq for r in known_items(items, articles).collect()} == {1}
    assert {r.seq: r.route for r in item_route(items, articles).collect()} == {1: "known", 2: "inline", 3: "detail"}
    assert {r.seq: r.route for r in item_route(items, articles, True).collect()} == {1: "detail", 2: "inline", 3: "detail"}
    assert {r.seq: (r.exists, r.stored_hash) for r in match_existing(items, articles).collect()} == {1: (True, None), 2: (True, None), 3: (False, None)}


def test_split_hot(spark):
    rows = spark.createDataFrame([("hot", i) for i in range(30)] + [(f"k{i}", i) for i in range(60)], "k string, i int")
    cold, hot = split_hot(rows, ["k"], 10)
    assert cold.count() == 60 and hot.count() == 30
    assert split_hot(rows, ["k"], 30)[1] is None


def test_blocks_follow_the_order(spark):
    rows = spark.createDataFrame([(i * i,) for i in range(1000)] + [(None,)], "seq bigint")
    blocked = with_blocks(rows, "seq", 100).groupBy("block").agg(F.min("seq").alias("a"), F.max("seq").alias("b"), F.count("*").alias("n"))
    found = [tuple(r) for r in blocked.orderBy("block").collect()]
    assert found[0][0] == 0 and sum(n for *_, n in found) == 1001  # rows without a place come first
    assert len(found) == 11 and all(n < 200 for *_, n in found)
    assert all(x[2] < y[1] for x, y in zip(found, found[1:]))


@pytest.mark.parametrize("rows_per_block", [10**6, 7])
def test_lookup_ids_are_dense_in_first_seen_order(spark, rows_per_block):
    rng = random.Random(5)
    names = [(rng.choice(["d1", "d2"]), rng.choice(["hot", f"n{rng.randrange(40)}", "", None]), seq) for seq in range(300)]
    lookup = [(4, "d1", "n1"), (9, "d2", "n2")]
    expected = {(d, n): i for i, d, n in lookup}
    for domain, name, _ in names:
        if name and (domain, name) not in expected:
            expected[domain, name] = max(expected.values()) + 1
    rng.shuffle(names)
    rows = spark.createDataFrame(names, "domain string, name string, seq bigint")
    stored = spark.createDataFrame(lookup, "id bigint, domain string, name string")
    merged = merge_lookups(stored, rows, rows_per_block=rows_per_block)
    assert {(r.domain, r.name): r.id for r in merged.collect()} == expected
    assert merge_lookups(merged, rows).count() == len(expected)

    attached = attach_lookup_ids(rows.withColumnRenamed("name", "category"), merged, "category", "category_id")
    ids = {r.seq: r.category_id for r in attached.collect()}
    assert ids == {seq: expected.get((d, n)) if n else None for d, n, seq in names}
