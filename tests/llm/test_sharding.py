from collections import Counter
from math import comb

import numpy as np
from pyspark.sql import functions as F

from broadsheet.llm.sharding import communication_matrix, hypergeometric, op4_hypergeometric_shards, shuffle_to_shards


def test_hypergeometric_has_the_right_distribution(spark):
    n = 4000
    for total, good, draws in ((100, 30, 20), (9, 9, 4), (100_000, 2500, 8192), (7, 0, 3), (50, 1, 49), (6, 4, 5)):
        drawn = hypergeometric(*(F.lit(x).cast("long") for x in (total, good, draws)), F.expr(f"(id + 0.5) / {n}"))
        got = np.array([r[0] for r in spark.range(n).select(drawn).collect()])
        expected = np.random.default_rng(1).hypergeometric(good, total - good, draws, 40_000)
        assert max(0, draws - total + good) <= got.min() and got.max() <= min(good, draws)
        assert abs(got.mean() - expected.mean()) < 0.05 + expected.std() / 30
        assert abs(got.std() - expected.std()) < 0.05 + expected.std() / 20


def test_matrix_margins(spark):
    sizes = {0: 5, 1: 0, 3: 17, 64: 8, 9000: 1}  # several levels of the tree, gaps, an empty block
    blocks = spark.createDataFrame(list(sizes.items()), "key long, n long")
    rows = {r.key: r.places for r in communication_matrix(blocks, 4, seed=3).collect()}
    assert {k: sum(v) for k, v in rows.items()} == sizes
    assert sorted(sum(c) for c in zip(*rows.values())) == [7, 8, 8, 8]


def test_matrix_is_uniform(spark):
    """Chi-square tests of whole matrices: what one block sends where, and what neighbours send together."""
    n_blocks, n = 3000, 4
    blocks = spark.range(n_blocks).select(F.col("id").alias("key"), F.lit(n).cast("long").alias("n"))
    total, each = n_blocks * n, n_blocks * n // 3
    ways = {(i, j, n - i - j): comb(each, i) * comb(each, j) * comb(each, n - i - j) / comb(total, n) for i in range(n + 1) for j in range(n + 1 - i)}
    pair = {k: comb(each, k) * comb(total - each, 2 * n - k) / comb(total, 2 * n) for k in range(2 * n + 1)}
    for seed in range(3):
        places = [tuple(r.places) for r in communication_matrix(blocks, 3, seed).orderBy("key").collect()]
        found = Counter(places)
        assert sum((found[w] - n_blocks * p) ** 2 / (n_blocks * p) for w, p in ways.items()) < 36.1  # 14 degrees of freedom, 1 in 1,000
        for shard in range(3):
            found = Counter(x[shard] + y[shard] for x, y in zip(places[::2], places[1::2]))
            assert sum((found[k] - n_blocks / 2 * p) ** 2 / (n_blocks / 2 * p) for k, p in pair.items()) < 26.1  # 8 degrees


def test_law_and_columns(spark, docs):
    rows = [(i // 2, None if i % 7 == 0 else f"text {i % 5}") for i in range(203)] + [(None, "x" * 50_000)]
    frame = docs(rows)
    out = shuffle_to_shards(frame, 8, block_rows=16)
    got = out.collect()
    assert len(got) == 204 and sorted(out.columns) == sorted({*frame.columns, "slot"})
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(rows, key=str)  # repeated rows stay
    by_shard = {}
    for r in got:
        by_shard.setdefault(r.shard, []).append(r.slot)
    assert sorted(by_shard) == list(range(8)) and {len(s) for s in by_shard.values()} <= {25, 26}
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())
    assert [r.asDict() for r in shuffle_to_shards(frame, 8, block_rows=16).orderBy("shard", "slot").limit(5).collect()] == [
        r.asDict() for r in out.orderBy("shard", "slot").limit(5).collect()
    ]
    assert shuffle_to_shards(frame.limit(0), 8).collect() == []
    few = shuffle_to_shards(docs([(1, "a"), (2, "b")]), 40).collect()
    assert len({r.shard for r in few}) == 2 and {r.slot for r in few} == {0}


def test_shuffle_is_uniform(spark):
    # where the first row of the input goes, over many seeds
    frame = spark.range(40).coalesce(1).withColumnRenamed("id", "x")
    hits = np.zeros(4)
    for seed in range(24):
        hits[shuffle_to_shards(frame, 4, seed=seed, block_rows=8).filter("x = 0").first().shard] += 1
    assert hits.max() <= 14


def test_query(spark, small):
    rows = op4_hypergeometric_shards(spark, small).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    import zlib

    assert all((r.size, r.text_crc32) == (len(texts[r.doc_id].encode()) + 16, zlib.crc32(texts[r.doc_id].encode())) for r in rows)
    assert len(rows) == len(texts) and {r.law for r in rows} == {"rows"} and {r.grown_shard for r in rows} == {None}
