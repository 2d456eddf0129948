"""Main text of pages by the recurrent block labeller."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import leaf_blocks
from .labeller import SAMPLE_PAGES, Labeller, train

#: Pages beyond so many bytes do not enter the sample of words the labeller is trained with.
SAMPLE_PAGE_BYTES = 1 << 20
GROUP_CHARS = 1 << 20
ARTICLE = "page_id long, url string, text string, n_chars long"


def sample_words(pages: DataFrame, n_pages: int = SAMPLE_PAGES) -> list[str]:
    """The words of about ``n_pages`` pages, at most twice as many, chosen and put in order by a hash, so files and tasks do not matter; only these come to the driver."""
    share = n_pages / max(pages.count(), 1)
    place = F.shiftrightunsigned(F.xxhash64("page_id", "url"), 11) / F.lit(2.0**53)
    chosen = pages.select("html", place.alias("place")).filter((F.col("place") < share) & (F.octet_length("html") <= SAMPLE_PAGE_BYTES))
    rows = chosen.orderBy("place", "html").limit(2 * n_pages).collect()
    return [word for r in rows for b in leaf_blocks(r.html) for word in b.text.split()]


def _extract(model: Labeller):
    def flush(rows: list) -> pa.RecordBatch:
        pages = [leaf_blocks(html) for _, _, html in rows]
        texts = ["\n".join(b.text for b, good in zip(page, labels) if good) for page, labels in zip(pages, model.label(pages))]
        columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for page_id, url, html in zip(batch.column("page_id"), batch.column("url"), batch.column("html")):
                rows.append((page_id.as_py(), url.as_py(), html.as_py() or ""))
                size += len(rows[-1][2])
                if size >= GROUP_CHARS:
                    yield flush(rows)
                    rows, size = [], 0
            if rows:
                yield flush(rows)

    return extract


def extract_articles(pages: DataFrame, model: Labeller | None = None) -> DataFrame:
    """page_id, url, text and n_chars for every row of ``pages`` (page_id long, url, html).

    The blocks of the article in page order, one per line. A null html, and a page without such blocks, has an empty text. Repeated rows
    get a result each; other columns are ignored; an empty table gives an empty one.
    """
    model = model or train(sample_words(pages))
    return pages.select("page_id", "url", "html").mapInArrow(_extract(model), ARTICLE)


def op10_block_labeller(spark, sf: str) -> DataFrame:
    """All pages' main text."""
    return extract_articles(spark.read.parquet(f"{sf}/pages.parquet"))
