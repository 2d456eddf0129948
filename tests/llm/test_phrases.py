import re
from collections import defaultdict

import pyarrow as pa

from broadsheet.llm.phrases import build_index, contamination, find_items, indexed_documents
from broadsheet.llm.words import NOT_ALNUM, text_words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=13):
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, item_text in items:
            v = words(item_text)
            n = min(window, len(v))
            wanted = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if n else set()
            for i in range(len(w) - n + 1) if n else ():
                if tuple(w[i : i + n]) in wanted:
                    hit |= set(range(i, i + n))
                    found.add(str(item))
        out.append((doc, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


LONG = " ".join(f"p{i}" for i in range(30))


def test_words():
    texts = ["", None, "A,b  C\x7fd éÀß x_y [Z] 9", "ÀÉ", "x" * 100_000 + " y"]
    hashes, counts = text_words(pa.array(texts), NOT_ALNUM, lower=True)
    assert counts.tolist() == [len(words(t)) for t in texts]
    one = lambda t: text_words(pa.array([t]), NOT_ALNUM, lower=True)[0].tolist()
    assert hashes.tolist() == [h for t in texts for w in words(t) for h in one(w)]
    table = pa.array(["zero", *texts, "last"]).slice(1, len(texts))  # an array that begins inside its buffer
    assert text_words(table, NOT_ALNUM, lower=True)[0].tolist() == hashes.tolist()


def test_against_brute_force(spark, docs):
    rows = [
        (1, f"before {LONG} after"), (2, LONG.upper().replace(" ", ", ")), (3, " ".join(LONG.split()[:12])), (4, " ".join(LONG.split()[10:23])),
        (5, None), (6, ""), (7, "!!! ---"), (8, "short item"), (9, "a short, ITEM b"), (10, f"{LONG} " * 3 + "filler " * 5000), (11, "one"), (11, "one"),
        (None, LONG), (12, "p0 p1 p2 p3 p4 p5 p6"), (13, "p7 p8 p9 p10 p11 p12 p13 p14"), (14, "filler " * 400 + LONG),
    ]
    items = [(1, LONG), (10, LONG + " p30"), (2, "short item"), (3, "ONE"), (4, None), (5, "?!"), (6, "never seen anywhere"), (7, "filler filler")]
    table = spark.createDataFrame([(*r, "clash") for r in items], "item_id long, text string, start string")
    got = contamination(docs(rows), table)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, items)
    assert contamination(docs(rows).limit(0), table).collect() == []
    assert {r.n_hit for r in contamination(docs(rows), table.limit(0)).collect()} == {0}


def test_matches_and_proximity(spark, docs):
    rows = [(1, "x alpha gap beta y"), (2, "alpha"), (3, "beta z z z z z alpha"), (4, "q alpha beta")]
    index = build_index(docs(rows))
    items = spark.createDataFrame([(1, "alpha beta")], "item_id int, text string")
    found = defaultdict(list)
    keys = {r.doc_key: r.doc_id for r in indexed_documents(index).collect()}
    for r in find_items(index, items, slop=3).collect():
        found[r.kind].append((keys[r.doc_key], r.start, r.length))
    assert found["phrase"] == [(4, 1, 2)]
    assert sorted(d for d, _, _ in found["proximity"]) == [1, 4]  # not across the end of document 2


def test_items_in_blocks(spark, docs, monkeypatch):
    import broadsheet.llm.phrases as phrases

    monkeypatch.setattr(phrases, "ITEM_BLOCK_BYTES", 64)
    rows = [(i, f"{LONG} own{i}") for i in range(3)]
    items = [(i, f"own{i} " * (i > 0) + LONG) for i in range(6)]
    got = contamination(docs(rows), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, items)


def test_blocks_of_a_repeated_item(spark, docs, monkeypatch):
    import broadsheet.llm.phrases as phrases

    monkeypatch.setattr(phrases, "ITEM_BLOCK_BYTES", 400)
    items = [(1, LONG)] * 50 + [(2, "short item"), (2, None)]
    table = spark.createDataFrame(items, "item_id long, text string")
    index = build_index(docs([(7, LONG), (8, "a short item")]))
    found = find_items(index, table).collect()
    assert sorted((r.item_id, r.start, r.length) for r in found) == [("1", 0, 30), ("2", 1, 2)]
