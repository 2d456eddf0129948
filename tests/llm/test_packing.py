import random

import numpy as np

from broadsheet.llm.packing import END_ID, RANKS, FreeSpace, _encoding, best_fit_decreasing, pack_tokens


def plain_best_fit(sizes, length):
    rows = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        room = [(length - sum(sizes[k] for k in row), -n) for n, row in enumerate(rows)]
        fits = [x for x in room if x[0] >= sizes[i]]
        if fits:
            rows[-min(fits)[1]].append(i)
        else:
            rows.append([i])
    return rows


def test_best_fit_decreasing():
    rng = random.Random(1)
    for length in (1, 2, 7, 16, 100):
        for _ in range(40):
            sizes = [rng.randint(1, length) for _ in range(rng.randint(0, 40))]
            rows = best_fit_decreasing(sizes, length)
            assert sorted(i for row in rows for i in row) == list(range(len(sizes)))
            free = lambda rows: sorted(length - sum(sizes[i] for i in row) for row in rows)
            assert free(rows) == free(plain_best_fit(sizes, length)) and min(free(rows), default=0) >= 0


def test_free_space():
    tree = FreeSpace(8)
    for space, row in ((3, 0), (8, 1), (0, 2), (3, 3)):
        tree.put(space, row)
    assert tree.take(4) == (8, 1) and tree.take(4) is None
    assert tree.take(1) == (3, 3) and tree.take(3) == (3, 0) and tree.take(1) is None


def test_round_trip(spark, docs):
    rows = [(1, "Hello  world\n" * 300), (2, None), (3, ""), (4, "<|endoftext|> is text"), (5, "é👍" * 50), (5, "same"), (5, "same"), (None, "no id"), (6, "long text " * 20_000)]
    out = pack_tokens(docs(rows), length=64, block_tokens=1000)
    pieces, filled = {}, 0
    for r in out.collect():
        ids, places = np.frombuffer(r.input_ids, np.uint16), np.frombuffer(r.position_ids, np.uint16)
        assert len(ids) == len(places) == 64 and r.n_tokens == r.cu_seqlens[-1] and (ids[r.n_tokens :] == END_ID).all()
        filled += r.n_tokens
        for doc, key, start, a, b in zip(r.doc_ids, r.doc_keys, r.starts, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            assert (places[a:b] == np.arange(b - a)).all()
            pieces.setdefault((doc, key), {})[start] = ids[a:b]
    decode = _encoding(RANKS).decode
    texts = []
    for (doc, _), parts in pieces.items():
        at, whole = 0, []
        for start in sorted(parts):
            assert start == at  # no gap, nothing twice
            at += len(parts[start])
            whole.append(parts[start])
        ids = np.concatenate(whole).tolist()
        assert ids[-1] == END_ID
        texts.append((doc, decode(ids[:-1])))
    assert sorted(texts, key=str) == sorted(((i, t or "") for i, t in rows), key=str)
    assert filled / (64 * out.count()) > 0.9
    assert pack_tokens(docs(rows).limit(0)).collect() == []
