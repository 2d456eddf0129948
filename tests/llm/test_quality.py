import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from broadsheet.llm.quality import counts, fit_weights, judge, op7_quality_rules, trusted_ids


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen, hit = Counter(grams), set()
    for i, g in enumerate(grams):
        hit |= {i, i + 1, i + 2} if seen[g] > 1 else set()
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


TEXTS = [
    None, "", " \n\t ", "a", "a b", "a b c", "a b c a b c", "a a a a a", "x y z w x y z", "é | <b>\né | <b>\n\n q", "\x0b\x0c a\x1cb\xa0c d", "a\n a\na \na",
    "u v w " * 3000, " ".join(str(i) for i in range(5000)), "👍 👍 👍 👍",
]


def test_counts_against_brute_force(spark, docs):
    rows = counts(docs(list(enumerate(TEXTS))), ["doc_id"]).drop("hashes").collect()
    assert {r.doc_id: tuple(r)[1:] for r in rows} == {i: brute(t) for i, t in enumerate(TEXTS)}


def test_counts_when_little_of_a_hash_fits(spark, docs, monkeypatch):
    """As for texts of very many words: windows meet by a few bits, and are told apart by the whole hash."""
    monkeypatch.setattr("broadsheet.llm.quality._place_bits", lambda size: F.lit(61))
    test_counts_against_brute_force(spark, docs)


@pytest.fixture(scope="module")
def corpus():
    good = [(i, " ".join(f"word{(i * 7 + k * k) % 211}" for k in range(80))) for i in range(60)]
    bad = [(100 + i, " ".join(f"JUNK{(i * 5 + k * k) % 97}!!" for k in range(80))) for i in range(40)]
    return good, bad


def test_verdicts(spark, docs, corpus):
    good, bad = corpus
    odd = [(200, None), (201, ""), (202, "too short"), (203, "a b c " * 40), (0, good[0][1]), (None, good[1][1])]
    frame = docs(good + bad + odd)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)] + [(100, 0, 0), (None, 1, 0), (5, 1, 0)], "doc_id long, quality int, toxic int")
    weights = fit_weights(frame, trusted_ids(labels))
    rows = judge(frame, weights).collect()
    assert len(rows) == len(good + bad + odd)
    kept = {r.doc_id for r in rows if r.kept}
    assert kept == {i for i, _ in good} | {None}
    assert {r.doc_id for r in rows if r.base_failed} == {200, 201, 202, 203}
    assert all(not r.kept for r in rows if r.base_failed)
    # no trusted document: the base rules alone decide
    nobody = fit_weights(frame, trusted_ids(labels.limit(0)))
    assert all(r.kept != r.base_failed and r.score == 0 for r in judge(frame, nobody).collect())
    empty = frame.limit(0)
    assert judge(empty, fit_weights(empty, trusted_ids(labels))).collect() == []


def test_weights_cover_all_documents(spark, docs, corpus):
    good, bad = corpus
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    counted = fit_weights(docs(good + bad, extra=False), trusted_ids(labels))
    grams = {g for _, t in good + bad for w in [t.split()] for g in [*w, *zip(w, w[1:])]}
    assert 0.95 * len(grams) < counted.count() <= len(grams)
    assert trusted_ids(labels, limit=10).count() < 25


def test_query(spark, small):
    table = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = op7_quality_rules(spark, small).collect()
    assert {r.doc_id: tuple(r)[1:6] for r in rows} == {i: brute(t) for i, t in table.items()}
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    judged = [(labels.get(r.doc_id), r.kept) for r in rows if not r.base_failed]
    assert all(kept for label, kept in judged if label == (1, 0))


def test_labelled_bad_documents_go(spark):
    """Of those that meet the base rules at most one in twenty stays; on much smaller corpora the prior outweighs the counts."""
    folder = "/root/testdata/sf0.01"
    bad = spark.read.parquet(f"{folder}/labels.parquet").filter("quality = 0").select("doc_id").distinct()
    judged = op7_quality_rules(spark, folder).join(bad, "doc_id").filter("NOT base_failed")
    n, kept = judged.agg(F.count("*"), F.count_if("kept")).first()
    assert n > 20 and 20 * kept <= n
