from collections import Counter, defaultdict

import numpy as np
import pytest

from broadsheet.llm.mixing import entropy, find_exponent, mix_sources, repetition, weights_at


def test_exponent():
    tokens = np.array([1000.0, 100, 100, 10, 0])
    natural = entropy(weights_at(tokens, 1.0)) / np.log(4)
    assert find_exponent(tokens, natural - 0.01, 1e9, None) == 1.0
    x = find_exponent(tokens, 0.9, 1e9, None)
    assert abs(entropy(weights_at(tokens, x)) / np.log(4) - 0.9) < 1e-6 and weights_at(tokens, x)[4] == 0
    y = find_exponent(tokens, 0.99, 4.0, None)
    assert abs(repetition(tokens, weights_at(tokens, y), None) - 4.0) < 1e-6 and y > find_exponent(tokens, 0.99, 1e9, None)
    assert find_exponent(np.zeros(0), 0.9, 4.0, None) == 1.0
    assert find_exponent(np.array([5.0]), 0.9, 4.0, None) == 1.0


@pytest.fixture(scope="module")
def table(spark):
    rows = [(i, "w " * (i % 7 + 1), "big", i) for i in range(300)] + [(1000 + i, "v " * 5, "small", i) for i in range(20)]
    rows += [(2000 + i, "u " * 4, None, i) for i in range(10)] + [(3000, None, "empty", 0), (3001, "", "empty", 0), (4000, "", "big", 0), (1000, "v " * 5, "small", 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, tokens long")


def test_whole_passes(spark, table):
    out = mix_sources(table, target_entropy=0.8, block_rows=16)
    rows = out.collect()
    assert set(out.columns) == {*table.columns, "mix_tokens", "mix_epoch", "mix_progress"}
    assert {r.doc_id for r in rows} == {r.doc_id for r in table.collect()}  # nothing is lost
    used = Counter()
    for r in rows:
        used[r.source] += r.mix_tokens
    sizes = {"big": sum(i % 7 + 1 for i in range(300)), "small": 105, None: 40}
    x = find_exponent(np.array([float(v) for v in sizes.values()]), 0.8, 4.0, None)
    weights = dict(zip(sizes, weights_at(np.array([float(v) for v in sizes.values()]), x)))
    total = max(sizes[s] / weights[s] for s in sizes)
    for s in sizes:
        assert weights[s] * total - 1 <= used[s] <= weights[s] * total + 7
    for s in sizes:  # a pass uses every row once; passes differ in order
        passes = defaultdict(list)
        for r in sorted((r for r in rows if r.source == s), key=lambda r: r.mix_progress):
            passes[r.mix_epoch].append(r.doc_id)
        whole = sorted(r.doc_id for r in table.collect() if r.source == s)
        for e in range(max(passes)):
            assert sorted(passes[e]) == whole
        assert set(passes[max(passes)]) <= set(whole)
        if len(passes) > 2:
            assert passes[0] != passes[1]
    # every stretch has about the weights
    ordered = sorted((r for r in rows if r.source in ("big", "small")), key=lambda r: r.mix_progress)
    half = Counter()
    for r in ordered[: len(ordered) // 2]:
        half[r.source] += r.mix_tokens
    assert abs(half["small"] / used["small"] - half["big"] / used["big"]) < 0.2
    assert sorted(map(str, out.collect())) == sorted(map(str, rows))


def test_budget_and_limits(spark, table):
    rows = mix_sources(table, target_entropy=0.0, budget=200.0, block_rows=16).collect()
    got = sum(r.mix_tokens for r in rows)
    assert 195 <= got <= 225 and max(r.mix_epoch for r in rows) == 0
    assert mix_sources(table.limit(0)).collect() == []
    only_empty = table.filter("source = 'empty'")
    assert sorted(r.doc_id for r in mix_sources(only_empty).collect()) == [3000, 3001]
