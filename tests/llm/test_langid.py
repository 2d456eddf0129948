import random
import unicodedata
from collections import Counter, defaultdict
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from broadsheet.llm import langid
from broadsheet.llm.langid import BASE_BITS, ORDER, Reader, fit_languages, identify_languages, op12_kneser_ney, units, windows

SCHEMA = "doc_id long, text string, lang string"


def normal(text):
    out = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in (text or "").lower())
    return " ".join(out.split()) + " " if any(unicodedata.category(c)[0] == "L" for c in out) else ""


def kneser_ney(texts):
    """Interpolated Kneser-Ney of order 4 from its definition; returns bits of a text."""
    padded = [" " * (ORDER - 1) + normal(t) for t in texts if normal(t)]
    counts = {ORDER: Counter(t[i : i + ORDER] for t in padded for i in range(len(t) - ORDER + 1))}
    for width in range(ORDER - 1, 0, -1):
        counts[width] = Counter(w[1:] for w in counts[width + 1])
    discount = {}
    for width, c in counts.items():
        once, twice = sum(n == 1 for n in c.values()), sum(n == 2 for n in c.values())
        discount[width] = once / (once + 2 * twice) if once and twice else 0.5
    totals, followers = defaultdict(Counter), defaultdict(Counter)
    for width, c in counts.items():
        for w, n in c.items():
            totals[width][w[:-1]] += n
            followers[width][w[:-1]] += 1

    def bits(text):
        line, total = " " * (ORDER - 1) + normal(text), 0.0
        for i in range(ORDER - 1, len(line)):
            p = 2.0**-BASE_BITS
            for width in range(1, ORDER + 1):
                w = line[i - width + 1 : i + 1]
                if totals[width][w[:-1]]:
                    d = discount[width]
                    p = (max(counts[width][w] - d, 0) + d * followers[width][w[:-1]] * p) / totals[width][w[:-1]]
            total -= log2(min(max(p, 2.0 ** -(2 * BASE_BITS)), 1))
        return total

    return bits


def test_units():
    assert units("Él  va, 12!\nno").tobytes().decode("utf-16-le") == "él va no "
    assert [len(units(x)) for x in (None, "", "12 +- 😀", "́")] == [0, 0, 0, 0]
    assert units("a😀b").tobytes().decode("utf-16-le") == "a b " and units("𝒜x").tobytes().decode("utf-16-le") == "𝒜x "
    texts = [units(x) for x in ("ab", "", "c d")]
    keys = windows([t for t in texts if len(t)])
    assert len(keys) == sum(map(len, texts)) and "".join(chr(int(k) & 0xFFFF) for k in keys) == "ab c d "
    assert chr(int(keys[2]) >> 32 & 0xFFFF) == "a" and chr(int(keys[3]) >> 16 & 0xFFFF) == " "


def test_probabilities_from_the_definition(spark, monkeypatch):
    monkeypatch.setattr(langid, "SLOTS", 1 << 34)  # no windows fall together
    rng = random.Random(2)
    words = {x: ["".join(rng.choice(letters) for _ in range(rng.randint(1, 5))) for _ in range(12)] for x, letters in (("aa", "abcdeé"), ("bb", "cdefgß"))}
    rows = [(i, " ".join(rng.choice(words[x]) for _ in range(rng.randint(0, 30))), x) for i, x in enumerate(("aa", "bb") * 60)]
    models = fit_languages(spark.createDataFrame(rows + [(None, None, "aa"), (3, "zz", None)], SCHEMA)).models
    texts = [t for _, t, _ in rows[:20] if normal(t)] + ["ein Wort", "b"]
    got = Reader(models).totals([units(t) for t in texts])
    assert models.names == ["aa", "bb"]
    for i, name in enumerate(models.names):
        bits = kneser_ney([t for _, t, x in rows if x == name])
        assert np.allclose(got[:, i], [bits(t) for t in texts], rtol=1e-5)


def test_odd_rows(spark):
    rows = [(i, "the thing and the other " * 3 if i % 2 else "der und die oder das nicht " * 3, "en" if i % 2 else "de") for i in range(60)]
    rows += [(100, None, "en"), (101, "", None), (102, "12 34", "de"), (103, "the other", None), (None, "das nicht", "de"), (103, "the other", None), (104, "oder das nicht " * 40_000, "en")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({n: F.lit("x") for n in ("key", "n", "fit", "score", "held_out", "totals")})
    held = F.col("doc_id") >= 100
    got = {(r.doc_id, r.lang_pred, r.held_out) for r in identify_languages(docs.drop("held_out"), held).collect() if r.doc_id is None or r.doc_id >= 100}
    assert got == {(100, "und", True), (101, "und", True), (102, "und", True), (103, "en", True), (104, "de", True), (None, "de", False)}
    out = identify_languages(docs, held).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    assert identify_languages(docs.limit(0), held).collect() == []
    unlearnt = identify_languages(docs.filter("doc_id > 99"), held).collect()
    assert {(r.lang_pred, r.score) for r in unlearnt} == {("und", 0.0)}


def test_held_out_accuracy_and_rejection(spark):
    folder = "/root/testdata/sf0.01"
    out = op12_kneser_ney(spark, folder).join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", "text"), "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert len(held) > 200 and sum(r.lang_pred == r.lang for r in held) / len(held) > 0.98
    assert np.mean([r.rejected for r in held]) < 0.05
    # a language that was never learnt is rejected, far more often than one that was
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    strange = identify_languages(docs, F.col("lang") == "de").filter("held_out").collect()
    assert np.mean([r.rejected for r in strange if r.n_units > 50]) > 0.9


def test_no_piece_boundary_shows(monkeypatch, spark):
    rows = [(i, f"word {chr(97 + i % 26)} " * (i % 9), "en" if i % 2 else "de") for i in range(80)]
    batch = pa.RecordBatch.from_pylist([{"text": t, "lang": x, "fit": i % 5 > 0} for i, t, x in rows])
    whole = langid._merged([(np.array(b.column("key")).view(np.uint64), np.stack([b.column("n"), b.column("n_fit")], axis=1)) for b in langid._counted(iter([batch]))])
    monkeypatch.setattr(langid, "_PIECE", 16)
    monkeypatch.setattr(langid, "_KNOWN", 8)
    parts = langid._merged([(np.array(b.column("key")).view(np.uint64), np.stack([b.column("n"), b.column("n_fit")], axis=1)) for b in langid._counted(iter([batch.slice(0, 33), batch.slice(33)]))])
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts))
