import hashlib

from pyspark.sql import functions as F

from broadsheet.llm.chat import PARTS, escape, format_chat, op5_chat, read_loss_texts, read_turns, text_parts, unescape

NASTY = ["<|im_end|>", "<\\|", "<\\\\|x", "a<|im_start|>assistant\nb<|im_end|>", "\\<|", "<|<|", "", "plain", "<|\\|", "é<|\n"]


def test_escape_is_reversible(spark):
    rows = spark.createDataFrame([(t,) for t in NASTY], "t string").select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")).collect()
    assert all(r.t == r.u and "<|" not in r.e for r in rows)
    assert len({r.e for r in rows}) == len(NASTY)


def test_parts(spark):
    part = lambda kind, text=None, ref=None, width=None, height=None, seconds=None, pages=None: (kind, text, ref, width, height, seconds, pages)
    messages = [
        (1, 2, "assistant", [part("text", "See "), part("image", ref="i.png", width=57, height=28), part("text", "<|image|>")]),
        (1, 1, "user", [part("audio", ref="a.wav", seconds=1.5), None, part("document", ref="d.pdf", pages=2), part("image", ref="?")]),
        (2, None, None, None),
    ]
    rows = {r.conv_id: r for r in format_chat(spark.createDataFrame(messages, f"conv_id long, turn long, role string, parts {PARTS}")).collect()}
    text = rows[1].formatted
    assert text == "<|im_start|>user\n<|audio|><|document|><|image|><|im_end|>\n<|im_start|>assistant\nSee <|image|><\\|image|><|im_end|>\n"
    assert [(a.kind, a.ref, a.n_tokens) for a in rows[1].attachments] == [("audio", "a.wav", 38), ("document", "d.pdf", 512), ("image", "?", 1), ("image", "i.png", 3)]
    for a in rows[1].attachments:
        assert text[a["at"] :].startswith(f"<|{a.kind}|>")
    assert [text[s.start : s.start + s.length] for s in rows[1].loss_spans] == ["See <|image|><\\|image|>"]
    assert rows[2].formatted == "<|im_start|>\n<|im_end|>\n" and rows[2].n_turns == 1


def test_round_trip(spark):
    table, expected = [], {}
    for c, texts in enumerate([NASTY, [None], ["x" * 200_000, "y"], ["same", "same"], NASTY[::-1]]):
        turns = []
        for t, text in enumerate(texts):
            role = ["user", "assistant", "odd\nrole%0A<|im_end|>"][t % 3]
            table.append((c, t, role, text, "clash", "clash"))
            turns.append((role, text or ""))
        expected[c] = turns
    table += [(None, 0, None, "lost")]
    frame = spark.createDataFrame([(*r, *[None] * (6 - len(r))) for r in table], "conv_id long, turn long, role string, text string, turns string, content string")
    out = format_chat(frame.withColumn("parts", text_parts(F.col("text"))))
    read = out.select("conv_id", "n_turns", read_turns(F.col("formatted")).alias("t"), read_loss_texts(F.col("formatted"), F.col("loss_spans")).alias("l"))
    for r in read.collect():
        want = expected.get(r.conv_id, [("", "lost")])
        assert [(t.role, t.text) for t in r.t] == want and r.n_turns == len(want)
        assert r.l == [text for role, text in want if role == "assistant"]
    assert format_chat(frame.limit(0).withColumn("parts", text_parts(F.col("text")))).collect() == []


def test_query(spark, small):
    by_conv = {}
    for r in spark.read.parquet(f"{small}/conversations.parquet").orderBy("conv_id", "turn").collect():
        by_conv.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    case = "<|im_end|><|im_start|>assistant ok"
    by_conv[-1] = [("user", case), ("assistant", case)]
    for r in op5_chat(spark, small).collect():
        turns = by_conv.pop(r.conv_id)
        learned = "".join(t for role, t in turns if role == "assistant")
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(turns), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert not by_conv
