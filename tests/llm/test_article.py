import time

import numpy as np
import pytest

from broadsheet.llm.article import extract_articles, sample_words
from broadsheet.llm.blocks import leaf_blocks, path_marks
from broadsheet.llm.labeller import Labeller, composed, padded, train


def texts(html):
    return [b.text for b in leaf_blocks(html)]


def test_blocks():
    assert texts("<p>a <b>b</b><br>c &amp; d&nbsp;&#233;<p>e</p>f") == ["a b c & d é", "e", "f"]
    assert texts("<script>if (a < b) '</p>'</script><style>p{}</style><!-- <p>x</p> --><p>y") == ["y"]
    assert texts("<ul><li>a<li>b</ul><table><tr><td>1<td>2</table>") == ["a", "b", "1", "2"]
    assert texts('<p title="a > b">x</p><p>1 < 2</p>') == ["x", "1 < 2"]
    assert texts("") == [] and texts("<div><span></span></div>") == [] and texts("plain") == ["plain"]
    assert texts("<p>cut <a href=") == ["cut"] and texts("<p>a</p><script>never ends <p>b") == ["a"]
    block = leaf_blocks('<body><div class="main-Content x" id=top><p>t')[0]
    assert path_marks(block.path) == [("p",), ("div", "@main", "@content", "@x", "@top"), ("body",)]


@pytest.mark.parametrize("piece", ['<a b="', "<a ", "<!--", "<", "<b><p>", "<div>", "</x>", "&amp;", "<script>", "<a b='\""])
def test_hostile_pages_take_linear_time(piece):
    start = time.process_time()
    leaf_blocks(piece * (400_000 // len(piece)))
    assert time.process_time() - start < 8


@pytest.fixture(scope="module")
def model():
    return train([f"word{i}" for i in range(500)], n_pages=700, epochs=6)


def test_gradients():
    pages, labels = composed(["a", "b"], 2, 5)
    pages, labels = [p[:4] for p in pages], [y[:4] for y in labels]
    x, mask = padded(pages)
    y = np.zeros_like(mask)
    for c, label in enumerate(labels):
        y[: len(label), c] = label
    net = Labeller(3)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    x = x.astype(np.float64)
    _, grads = net.gradients(x, mask, y)
    rng = np.random.default_rng(0)
    for name in net.w:
        at = np.unravel_index(np.argmax(np.abs(grads[name])), grads[name].shape) if rng.random() < 2 else None
        old = net.w[name][at]
        net.w[name][at] = old + 1e-3
        up = net.gradients(x, mask, y)[0]
        net.w[name][at] = old - 1e-3
        down = net.gradients(x, mask, y)[0]
        net.w[name][at] = old
        assert abs((up - down) / 2e-3 - grads[name][at]) < 1e-3 + 0.02 * abs(grads[name][at]), name


def test_held_out_accuracy(model):
    pages, labels = composed([f"other{i}" for i in range(300)], 200, 77)
    got = model.label(pages)
    assert np.mean(np.concatenate(got) == np.concatenate(labels)) > 0.985
    # a page's labels do not depend on the pages it is batched with
    assert all((model.label([p])[0] == g).all() for p, g in list(zip(pages, got))[:20])


def test_extract(spark, model):
    page = "<html><head><title>t</title></head><body><nav><ul><li><a href=/>Home</a></li><li><a href=/x>More</a></li></ul></nav><div class=ad>Buy now</div>{}<footer>&copy; me</footer></body></html>"
    article = "<article><h1>The   title</h1><p>First &lt;paragraph&gt; of the text.</p><p>Second<br>one.</p></article>"
    rows = [(1, "u", page.format(article)), (1, "u", page.format(article)), (2, None, None), (3, "u", ""), (None, "u", page.format("")), (4, "u", page.format("<article>" + "<p>Words of a long page.</p>" * 20_000 + "</article>"))]
    frame = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, text string, n_chars string")
    got = extract_articles(frame, model).collect()
    by_id = {r.page_id: r for r in got}
    assert len(got) == 6 and by_id[1].text == "The title\nFirst <paragraph> of the text.\nSecond one." and by_id[1].n_chars == len(by_id[1].text)
    assert (by_id[2].text, by_id[3].text, by_id[None].text) == ("", "", "")
    assert by_id[4].text == "\n".join(["Words of a long page."] * 20_000)
    assert extract_articles(frame.limit(0), model).collect() == []


def test_pages_of_the_table(spark, small):
    # every page there has its article in an element of that name
    pages = spark.read.parquet(f"{small}/pages.parquet")
    got = {r.page_id: r.text for r in extract_articles(pages, train(sample_words(pages), n_pages=1000)).collect()}
    for r in pages.collect():
        truth = "\n".join(b.text for b in leaf_blocks(r.html) if any("article" in marks for marks in path_marks(b.path)))
        assert got[r.page_id] == truth


SENTENCE = "The council met on Tuesday and agreed to repair the old bridge over the river before winter."
# Layouts and names that the composer does not have; the blocks of the article end with a star.
UNSEEN = {
    "names of a blog": f"""<div id=hfeed><ul class=topmenu><li><a href=/>Home</a></li><li><a href=/a>About us</a></li></ul>
        <div class=hentry><h1>Bridge repaired*</h1><p>{SENTENCE}*</p><p>{SENTENCE} Again.*</p><p>{SENTENCE} And once more.*</p></div>
        <ol class=commentlist><li><p>I like this.</p></li><li><p>Me too, very much so.</p></li></ol><div id=colophon>Copyright</div></div>""",
    "a table": f"""<table><tr><td width=150><a href=/>Home</a><br><a href=/n>News</a></td><td><h1>Bridge*</h1><p>{SENTENCE}*</p><p>{SENTENCE} Two.*</p></td></tr>
        <tr><td colspan=2>Copyright 2001</td></tr></table>""",
    "nothing around": f"<h1>Bridge*</h1><p>{SENTENCE}*</p><p>{SENTENCE} Two.*</p><p>{SENTENCE} Three.*</p>",
}


@pytest.fixture(scope="module")
def full(spark, small):
    return train(sample_words(spark.read.parquet(f"{small}/pages.parquet")))


@pytest.mark.parametrize("layout", UNSEEN)
def test_unseen_layouts(full, layout):
    blocks = leaf_blocks(f"<html><body>{UNSEEN[layout]}</body></html>")
    expected = [b.text.endswith("*") for b in blocks]
    for b in blocks:
        b.text = b.text.rstrip("*")
    assert full.label([blocks])[0].tolist() == expected


def test_sample_does_not_depend_on_files(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    assert sample_words(pages, 20) == sample_words(pages.repartition(7, "html"), 20)
