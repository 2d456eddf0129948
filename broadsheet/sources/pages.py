"""Fetched pages as a table, a folder of HTML files, or a stream."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import or_null
from ..functions.urls import url_host

PAGES = "url string, html string"

# Fixed values, from the encoding standard: names of UTF-8, names that mean Windows-1252, and the characters that it has in place of C1 controls.
UTF8_NAMES = ["utf-8", "utf8", "us-ascii-utf-8", "unicode-1-1-utf-8"]
LATIN_NAMES = ["iso-8859-1", "iso8859-1", "latin1", "latin-1", "l1", "windows-1252", "cp1252", "ascii", "us-ascii"]
LATIN_CONTROLS = "\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9e\x9f"
LATIN_LETTERS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"

#: A meta element with a charset counts in so many bytes.
META_BYTES = 1024
META = r"(?i)<meta[^>]*charset[^>]*"
CHARSET = r"""(?i)charset\s*=\s*["']?\s*([a-zA-Z0-9_:.\-]+)"""


def read_pages(spark: SparkSession, path: str, format: str = "parquet", partitions: int | None = None) -> DataFrame:
    """Any source of ``url, html``, with ``domain`` where the table does not name it.

    ``partitions`` deals the pages out anew, for few and small files whose pages cost more than their bytes.
    """
    pages = spark.read.format(format).load(path)
    return with_domain(pages.repartition(partitions) if partitions else pages)


def declared_charset(content: Column, header: Column | None = None) -> Column:
    """The charset of a page's bytes, in lower case: that of a byte-order mark, else of a Content-Type header, else of a meta element in its beginning, else UTF-8."""
    start = F.hex(F.substring(content, 1, 3))
    mark = F.when(start == "EFBBBF", "utf-8").when(start.startswith("FFFE"), "utf-16le").when(start.startswith("FEFF"), "utf-16be")
    named = lambda text: or_null(F.lower(F.regexp_extract(text, CHARSET, 1)))
    # ASCII bytes say the same in every charset that a meta element can name
    beginning = F.make_valid_utf8(F.substring(content, 1, META_BYTES).cast("string"))
    meta = named(F.regexp_extract(beginning, META, 0))
    return F.coalesce(mark, *([named(header)] if header is not None else []), meta, F.lit("utf-8"))


def _decode_others(content: pa.Array, charset: pa.Array) -> pa.Array:
    def text(data: bytes | None, name: str | None) -> str | None:
        if data is None:
            return None
        try:
            return data.decode(name or "utf-8", "replace").removeprefix("\ufeff")
        except LookupError:
            return data.decode("utf-8", "replace")

    return pa.array((text(d, n) for d, n in zip(content.to_pylist(), charset.to_pylist())), pa.string())


def decoded(content: Column, header: Column | None = None) -> Column:
    """A page's bytes as text, in the charset that ``declared_charset`` finds. Bytes that mean nothing in it become U+FFFD; a charset that nobody knows is taken for UTF-8.

    UTF-8 and the Latin charsets, that is nearly all pages, are decoded natively; only bytes in other charsets go to Python.
    """
    charset = declared_charset(content, header)
    utf8 = charset.isin(UTF8_NAMES)
    latin = charset.isin(LATIN_NAMES)
    unmarked = F.when(F.hex(F.substring(content, 1, 3)) == "EFBBBF", F.expr("substring(_content, 4)")).otherwise(F.col("_content"))
    as_utf8 = F.make_valid_utf8(unmarked.cast("string"))
    as_latin = F.translate(F.decode(content, "ISO-8859-1"), LATIN_CONTROLS, LATIN_LETTERS)
    others = F.arrow_udf(_decode_others, "string")(F.when(~utf8 & ~latin, content), charset)
    return F.when(utf8, as_utf8).when(latin, as_latin).otherwise(others)


def with_html(files: DataFrame, content: str = "content", header: str | None = None) -> DataFrame:
    """Replace a column of bytes, and that of their headers, by ``html``."""
    marked = files.withColumn("_content", F.col(content))
    html = decoded(F.col("_content"), F.col(header) if header else None)
    return marked.withColumn("html", html).drop("_content", content, *([header] if header else []))


def read_html_files(spark: SparkSession, folder: str, base_url: str, encoding: str | None = None) -> DataFrame:
    """A folder of saved pages; a page's URL is ``base_url`` plus its path below the folder. Each file has its own charset, unless ``encoding`` names one for all."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    anchor = F.concat(F.lit("/"), F.lit(folder.strip("/")), F.lit("/"))
    below = F.element_at(F.split(F.col("path"), F.concat(F.lit("\\Q"), anchor, F.lit("\\E")), 2), -1)
    pages = files.select(F.concat(F.lit(base_url.rstrip("/") + "/"), below).alias("url"), "content")
    return with_domain(pages.select("url", F.decode("content", encoding).alias("html")) if encoding else with_html(pages))


def stream_pages(spark: SparkSession, folder: str, schema: str = PAGES, files_per_batch: int = 1000) -> DataFrame:
    """New Parquet files of pages as they arrive."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    return with_domain(stream)


def with_domain(pages: DataFrame) -> DataFrame:
    return pages if "domain" in pages.columns else pages.withColumn("domain", url_host("url"))
