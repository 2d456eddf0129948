from functools import partial

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from broadsheet.llm.mixing import mix_sources
from broadsheet.llm.near import similarity
from broadsheet.llm.packing import RANKS, _encoding, pack_tokens
from broadsheet.session import materialize
from test_near import sequence
from test_phrases import brute


def test_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, kept = docs.columns, [{r.doc_id: r.text for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, small))
        assert docs.columns == columns, name
        kept.append({r.doc_id: r.text for r in docs.collect()})
    start, good, single, clean, mixed = kept
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    assert set(good) <= set(start)
    # what is gone is labelled bad, too short or repetitive
    for i in set(start) - set(good):
        words = start[i].split()
        windows = list(zip(words, words[1:], words[2:]))
        assert labels.get(i) != (1, 0) or len(words) < 50 or len(windows) - len(set(windows)) > len(words) / 8 or i not in labels
    sequences = {i: sequence(t) for i, t in good.items()}
    for i in set(good) - set(single):
        assert any(similarity(sequences[i], sequences[j]) for j in single if j != i) or any(j not in single and j != i and similarity(sequences[i], sequences[j]) for j in good)
    ids = sorted(single)
    assert not any(similarity(sequences[i], sequences[j]) for k, i in enumerate(ids) for j in ids[:k])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    dirty = {row[0] for row in brute(list(single.items()), items) if row[4]}
    assert set(clean) == set(single) - dirty
    assert set(mixed) == set(clean)
    decode = _encoding(RANKS).decode
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, small).collect()
    pieces = {}
    for r in packed:
        tokens = np.frombuffer(r.input_ids, np.uint16)
        for doc, key, at, a, b in zip(r.doc_ids, r.doc_keys, r.starts, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            pieces.setdefault((doc, key), {})[at] = tokens[a:b]
    got = {doc: decode(np.concatenate([parts[s] for s in sorted(parts)]).tolist()[:-1]) for (doc, _), parts in pieces.items()}
    assert got == clean


def test_run_equals_its_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, small))
    whole = corpus_pipeline.run(spark, small)
    ids = lambda df: sorted(r[0] for r in df.select(F.explode("doc_ids")).collect())
    assert whole.columns == docs.columns and ids(whole) == ids(docs)


def test_blocks_hold_the_weights_in_order(spark, monkeypatch):
    source = lambda i: "a" if i < 6000 else "b" if i < 7500 else "c"
    rows = [(i, " ".join(f"w{(i * 31 + j * j) % 997}" for j in range(30)), source(i)) for i in range(8000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    monkeypatch.setattr(corpus_pipeline, "pack_tokens", partial(pack_tokens, block_tokens=20_000))
    conf = {"spark.sql.shuffle.partitions": "5", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        mixed = materialize(corpus_pipeline.mix(spark, docs, ""))
        packed = corpus_pipeline.pack(spark, mixed, "").select("block", "cu_seqlens", "doc_ids").collect()
        uses = mix_sources(docs).select("doc_id", "source", "mix_epoch", "mix_progress").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    blocks = {}
    for r in packed:
        for doc, a, b in zip(r.doc_ids, r.cu_seqlens, r.cu_seqlens[1:]):
            blocks.setdefault(r.block, []).append((doc, b - a))
    share = lambda pieces, s: sum(n for d, n in pieces if source(d) == s) / sum(n for _, n in pieces)
    every = [p for pieces in blocks.values() for p in pieces]
    whole = [pieces for pieces in blocks.values() if sum(n for _, n in pieces) >= 20_000]
    assert len(whole) >= 10
    for pieces in whole:
        for s in "abc":
            assert abs(share(pieces, s) - share(every, s)) < 0.03
    # the blocks follow each other as the mixture does; documents of the large source come once
    at = {r.doc_id: r.mix_progress for r in uses if r.source == "a"}
    assert {r.mix_epoch for r in uses if r.source == "a"} == {0} and len(at) == 6000
    spans = [[at[d] for d, _ in blocks[k] if d in at] for k in sorted(blocks)]
    spans = [(min(s), max(s)) for s in spans if s]
    assert all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def clashing(docs):
    names = ["digest", "least", "none", "root", "node", "place", "tokens", "mix_tokens", "mix_epoch", "mix_progress", "k_id", "kept", "file", "at"]
    return docs.withColumns({n: F.lit(f"{n} of the input") for n in names})


def test_empty_tables(spark, small):
    docs = spark.createDataFrame([], COLUMNS)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, small))
        assert docs.count() == 0, name


def test_odd_rows_of_the_pipeline(spark, small):
    long = " ".join(f"word{i % 1999}x{i % 7}" for i in range(60_000))
    text = " ".join(f"w{i}" for i in range(120))
    rows = [(1, text, "en", "a", 1), (1, text, "en", "a", 1), (2, text + " end", "en", "b", 1), (None, text, "en", "a", 1), (None, text, None, None, None)]
    rows += [(3, None, "en", "a", 0), (4, "", "en", None, 0), (None, None, "en", "a", 0), (5, long, "en", "c", 1), (None, "only here " * 3, "en", "c", 1), (None, "only here " * 3, "en", "c", 1)]
    docs = clashing(spark.createDataFrame(rows, COLUMNS))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialize(stage(spark, docs, small))
        assert out.columns == docs.columns, name
    single = corpus_pipeline.deduplicate(spark, docs, small)
    # rows without an id are near duplicates like others: a class keeps its smallest id, or one row where it has none
    assert sorted(((r.doc_id, (r.text or "")[:9]) for r in single.collect()), key=str) == sorted([(1, text[:9]), (3, ""), (5, long[:9]), (None, "only here")], key=str)
    mixed = materialize(corpus_pipeline.mix(spark, single, small))
    assert {(r.doc_id, r.text, r.digest, r.mix_progress) for r in mixed.collect()} == {(r.doc_id, r.text, "digest of the input", "mix_progress of the input") for r in single.collect()}
    packed = corpus_pipeline.pack(spark, mixed, small).collect()
    assert {d for r in packed for d in r.doc_ids} == {1, 3, 5, None}


def test_pack_without_files(spark, small):
    """A table that no task wrote is packed as it comes."""
    docs = spark.createDataFrame([(i, f"text {i}", "en", "a", 1) for i in range(50)], COLUMNS)
    assert sorted(d for r in corpus_pipeline.pack(spark, docs, small).collect() for d in r.doc_ids) == list(range(50))
