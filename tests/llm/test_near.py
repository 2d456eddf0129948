import random

import numpy as np
import pyarrow as pa

from broadsheet.llm.near import banded_matches, components, near_duplicate_classes, shingles, similarity, sketch
from broadsheet.llm.words import WHITE, text_words


def longest_common(a, b):
    before = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(before[j + 1], row[j]))
        before = row
    return before[-1]


def sequence(text):
    return shingles(text_words(pa.array([text], pa.string()), WHITE)[0])


def brute(rows):
    """Classes by comparing everything with everything."""
    sequences = [sequence(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            m = longest_common(sequences[i].tolist(), sequences[j].tolist())
            if m / (len(sequences[i]) + len(sequences[j]) - m) >= 0.8:
                root[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((doc, least.get(find(i))) for i, (doc, _) in enumerate(rows)), key=str)


def test_alignment_against_the_table():
    rng = random.Random(4)
    for _ in range(150):
        a = [rng.randint(0, 5) for _ in range(rng.randint(1, 40))]
        b = [rng.randint(0, 5) for _ in range(rng.randint(1, 40))]
        assert banded_matches(a, b, 50) == longest_common(a, b)
        c = list(a)
        for _ in range(rng.randint(0, 4)):
            c[rng.randrange(len(c))] = rng.randint(0, 9)
        m = longest_common(a, c)
        exact = m / (len(a) + len(c) - m)
        got = similarity(np.array(a, np.uint64), np.array(c, np.uint64))
        assert abs(got - (exact if exact >= 0.8 else 0)) < 1e-9


def test_sketch_feels_order():
    words = [f"w{i}" for i in range(400)]
    base, moved = sequence(" ".join(words)), sequence(" ".join(words[200:] + words[:200]))
    edited = sequence(" ".join(w if i % 100 else "new" for i, w in enumerate(words)))
    shared = lambda a, b: int((sketch(a) == sketch(b)).sum())
    assert shared(base, base) == 32
    assert shared(base, edited) > shared(base, moved)
    assert similarity(base, edited) > 0.8 and similarity(base, moved) == 0


def test_against_brute_force(spark, docs):
    rng = random.Random(9)
    words = lambda n: [f"w{rng.randint(0, 400)}" for _ in range(n)]
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a"), (5, "a"), (6, "a b c"), (7, "a  b\tc"), (None, "a b c"), (None, "alone without id")]
    passage = words(60)
    for k in range(12):  # documents that share a passage but are not copies
        rows.append((20 + k, " ".join(words(60) + passage + words(40))))
    base = words(150)
    for k in range(30):  # copies of copies, some near the threshold
        text = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 6])):
            text[rng.randrange(len(text))] = "edit" + str(rng.random())
        rows.append((100 + k, " ".join(text)))
    rows += [(100, rows[-1][1]), (200, " ".join(base[75:] + base[:75])), (300, "long " * 30_000), (301, "long " * 29_000)]
    got = sorted((tuple(r) for r in near_duplicate_classes(docs(rows)).collect()), key=str)
    few = [r for r in rows if r[0] not in (300, 301)]
    assert [g for g in got if g[0] not in (300, 301)] == brute(few)
    assert (300, 300) in got and (301, 300) in got
    assert near_duplicate_classes(docs(rows).limit(0)).collect() == []


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 60), (60, 80), (7, 7), (200, 201)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 60, 60: 60, 80: 60, 200: 200, 201: 200}


def test_hub_of_a_large_group(spark, docs):
    # most copies are similar to the middle one only
    rng = random.Random(2)
    base = [f"b{i}" for i in range(200)]
    rows = [(500, " ".join(base))]
    for k in range(60):
        text = list(base)
        for _ in range(3):
            text[rng.randrange(200)] = f"x{k}"
        rows.append((k, " ".join(text)))
    assert {r.class_id for r in near_duplicate_classes(docs(rows)).collect()} == {0}


def by_similarity(rows):
    """Classes by comparing everything with everything, with the similarity that another test compares with the table."""
    sequences, root = [sequence(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if similarity(sequences[i], sequences[j]):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return {doc: rows[root[i]][0] for i, (doc, _) in enumerate(rows)}


def test_pairs_inside_a_bucket_of_a_shared_passage(spark, docs):
    # 151 of 172 shingles in common: 0.782; each pair has three more: 0.81, mostly without a key of its own
    passage, rows = [f"p{i}" for i in range(155)], []
    for k in range(160):
        rows.append((k, " ".join(passage + [f"pair{k // 2}x{i}" for i in range(3)] + [f"own{k}x{i}" for i in range(18)])))
    want = by_similarity(rows)
    assert set(want.values()) == set(range(0, 160, 2))
    assert {r.doc_id: r.class_id for r in near_duplicate_classes(docs(rows)).collect()} == want


def test_short_texts(spark, docs):
    words = lambda k, n: [f"k{k}w{i}" for i in range(n)]
    rows = [(1, " ".join(words(1, 8))), (2, " ".join(words(1, 9))), (3, " ".join(["before"] + words(2, 8))), (4, " ".join(words(2, 8)))]
    rows += [(5, " ".join(words(3, 8))), (6, " ".join(words(3, 7) + ["other"])), (7, " ".join(words(4, 24))), (8, " ".join(words(4, 29))), (9, "a b"), (10, "a  b"), (11, "a c")]
    for k in range(10, 40):  # sizes around those of a sketch, at 0.8 and just below
        rows += [(100 * k + i, " ".join(words(k, 8 + k % 6 + i))) for i in (0, 1, 3)]
    got = {r.doc_id: r.class_id for r in near_duplicate_classes(docs(rows)).collect()}
    assert got == by_similarity(rows)
    assert [got[i] for i in range(1, 12)] == [1, 1, 3, 3, 5, 6, 7, 7, 9, 9, 11]
