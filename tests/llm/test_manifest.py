import sys
from hashlib import sha256
from pathlib import Path
from zlib import crc32

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent.parent))

from broadsheet.llm import manifest  # noqa: E402
from broadsheet.llm.manifest import LOWER, OP13_SQL, UPPER, append_log, build_manifest, height_of, postorder_position, reader, siblings  # noqa: E402
from check_queries import connect  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def digest(text):
    return sha256(text.encode()).hexdigest()


def told(x):
    return "-" if x is None else f"{len(str(x).encode())}:{x}"


def levels(leaves, fanout):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i : i + fanout])) for i in range(0, len(out[-1]), fanout)])
    return out


def brute(rows, tamper, fanout):
    leaf = lambda d, text: digest("".join(map(told, (d[0], d[3], d[2], d[4], text))))
    sources = {}
    for d in rows:
        sources.setdefault(d[3], []).append((d[0] is not None, d[0] or 0, leaf(d, d[1]), d))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([x[2] for x in sorted(sources[s], key=lambda x: x[:3])], fanout) for s in names}
    top = levels([trees[s][-1][0] for s in names], fanout)
    out = []
    for k, s in enumerate(names):
        for i, (_, _, h, d) in enumerate(sorted(sources[s], key=lambda x: x[:3])):
            path = []
            for tree, at in ((trees[s], i), (top, k)):
                for level in tree[:-1]:
                    first = at - at % fanout
                    path.append(("".join(level[first:at]), "".join(level[at + 1 : first + fanout])))
                    at //= fanout
            cur = leaf(d, tamper(d))
            for before, after in path:
                cur = digest(before + cur + after)
            root = top[-1][0]
            out.append((d[0], h, trees[s][-1][0], root, digest("".join(b + a for b, a in path)), cur, cur == root))
    return sorted(out, key=str)


def tampered(d):
    return d[1].translate(str.maketrans(UPPER, LOWER)) if d[0] is not None and d[1] is not None and crc32(str(d[0]).encode()) % 5 == 0 else d[1]


def proofs(spark, rows, extra=False):
    docs = spark.createDataFrame(rows, SCHEMA)
    if extra:
        docs = docs.withColumns({n: F.lit("x") for n in ("tree", "at", "leaf", "root", "digest", "row", "part", "n")})
    changed = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.translate("text", UPPER, LOWER))
    return sorted((tuple(r) for r in build_manifest(docs, changed).proofs().collect()), key=str)


def test_positions_and_logs():
    for n in [*range(1, 70), 255, 256, 257, 4095, 4096]:
        for height in {height_of(n), 3}:
            if manifest.FANOUT**height < n:
                continue
            leaves = [sha256(bytes([i % 256, i // 256])).digest() for i in range(n)]
            log = append_log(leaves, height)
            read = reader(b"".join(log), n, height)
            count, places = n, []
            for level in range(height + 1):
                places += [postorder_position(level, i, n, height) for i in range(count)]
                if level < height:
                    above = -(-count // 16)
                    for i in range(above):
                        assert read(level + 1, i) == digest("".join(read(level, k) for k in range(16 * i, min(count, 16 * i + 16))))
                    count = above
            assert sorted(places) == list(range(len(log))) and read(height, 0) == log[-1].hex()
            assert len(siblings(read, n - 1, n, height)) == height


def test_odd_rows(spark):
    rows = [(i, f"Text {i}", "en", "a", i) for i in range(40)] + [(i, f"T{i}", None, f"s{i}", None) for i in range(100, 120)]
    rows += [(1, None, "en", None, 0), (2, "", "en", None, 0), (None, "No Id", "x", "é", 3), (None, None, None, None, None), (7, "Same", "en", "a", 1), (7, "Same", "en", "a", 1), (3, "A" * 200_000, "en", "", 5)]
    expected = brute(rows, tampered, 16)
    assert proofs(spark, rows) == expected and proofs(spark, rows, extra=True) == expected
    assert {r[6] for r in expected} == {True, False}
    assert proofs(spark, []) == []
    alone = proofs(spark, [(5, "one", "en", "a", 3)])
    assert alone[0][1] == alone[0][2] == alone[0][3] and alone[0][4] == digest("")


def test_trees_of_several_tiers(spark):
    rows = [(i, f"Text {i}", "en", "big" if i % 3 else f"s{i % 30}", i) for i in range(60)] + [(5000 + i, "Same", "en", "big", 0) for i in range(4200)]
    assert proofs(spark, rows) == brute(rows, tampered, 16)


@pytest.mark.parametrize("table", ["/root/testdata/sf0.001"])
def test_sql(spark, table):
    got = sorted((tuple(r) for r in manifest.op13_merkle_manifest(spark, table).collect()), key=str)
    assert got == sorted(connect(table).execute(OP13_SQL).fetchall(), key=str)
