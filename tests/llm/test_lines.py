
from collections import defaultdict

from broadsheet.llm.lines import LineRuns, drop_repeated_lines

A, B = "A line that is long enough to count, with É in it", "another line that is quite long enough to count here"


def brute(rows, min_chars=40, min_documents=5):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    docs = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            docs[key(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        heavy = lambda k: len(k) >= min_chars and len(docs[k]) >= min_documents and i != max((d for d in docs[k] if d is not None), default=None)
        left = [x for x in lines if not heavy(key(x))]
        out.append((i, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=str)


def test_against_brute_force(spark, docs):
    rows = [(i, f"{A}\nown {i}") for i in range(1, 5)] + [(9, f" \t{A.upper().replace('É', 'É')} \x0b\n{A}\n")]
    rows += [(20 + i, f"{B}\n{B}\nx") for i in range(4)] + [(30, None), (31, ""), (32, "\n\n"), (33, A), (33, A), (None, f"{A}\nnobody"), (None, B)]
    rows += [(40, "\n".join([A, B, "tail"] * 3000)), (41, "x" * 39 + "\n" + "y" * 40)] + [(50 + i, "y" * 40) for i in range(3)] + [(60 + i, "z" * 39) for i in range(6)]
    got = drop_repeated_lines(docs(rows))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)
    for batches in (1, 7):
        assert sorted((tuple(r) for r in drop_repeated_lines(docs(rows), batches=batches).collect()), key=str) == brute(rows)
    assert drop_repeated_lines(docs(rows).limit(0)).collect() == []


def test_runs_are_levelled(spark):
    runs = LineRuns(spark, fan=2, buckets=2)
    for batch in range(7):
        rows = [(k, k, 100 - 10 * batch + d) for k in range(batch, batch + 3) for d in range(2)]
        runs.add(spark.createDataFrame(rows, "k1 long, k2 long, doc_id long"))
        assert len(runs.tables()) == bin(batch + 1).count("1")  # merged as a binary counter
    totals = {r.k1: (r.n_docs, r.last_doc) for r in runs.totals().collect()}
    assert totals == {k: (2 * sum(b <= k < b + 3 for b in range(7)), 101 - 10 * max(0, k - 2)) for k in range(9)}
    fresh = runs.unseen(spark.createDataFrame([(3, 3), (50, 50)], "k1 long, k2 long")).collect()
    assert [tuple(r) for r in fresh] == [(50, 50)]
    name = runs.tables()[0]
    runs.close()
    assert not spark.catalog.tableExists(name)




def test_no_table_names_are_left(spark, small):
    before = {t.name for t in spark.catalog.listTables()}
    from broadsheet.llm.lines import op3_line_runs

    assert op3_line_runs(spark, small).count() == 200
    assert {t.name for t in spark.catalog.listTables()} == before
