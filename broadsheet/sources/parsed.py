"""Parsed pages that outlive a run: what was read from a page is kept under what it was read from.

A plain Parquet folder that is only appended to. A row's key is the site, the URL, and the digests of the html and of the config; its values are
what the extraction gave. The same key always has the same values, so a run that failed leaves nothing wrong behind, and
no run parses a page that any run parsed before.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from .. import schemas
from ..functions.html import both
from ..operators.joins import broadcast_if_small
from ..session import arrow_batches, empty_table, materialize

#: Part of the config's digest; rises whenever the extraction reads pages differently.
READER = 1
#: Pages go to Python so many bytes at a time. A worker holds two such batches, that which it reads and the next, whatever the session allows.
BATCH_BYTES = 4 << 20
PAGE_KEY = ["site", "url", "html_key", "config_key"]


def with_keys(pages: DataFrame) -> DataFrame:
    """Add ``html_key`` and ``config_key`` to pages with their site's config. A page without html has a key of its own."""
    return pages.withColumns({
        "html_key": F.coalesce(F.sha2("html", 256), F.lit("none")),
        "config_key": F.sha2(F.concat(F.lit(f"{READER} "), F.coalesce("config", F.lit(""))), 256),
    })


class ParsedPages:
    """One writer at a time, as for any folder of Parquet files."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, root
        read = DataType.fromDDL(schemas.BOTH)
        keys = StructType.fromDDL(", ".join(f"{c} string" for c in PAGE_KEY))
        self.schema = StructType([*keys.fields, *read.fields])

    def rows(self) -> DataFrame:
        """``PAGE_KEY`` and the fields of the extraction; an empty typed table until something was parsed."""
        try:
            return self.spark.read.schema(self.schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return empty_table(self.spark, self.schema)

    def missing(self, keyed: DataFrame) -> DataFrame:
        """The keys of ``keyed`` that were never parsed."""
        return keyed.select(*PAGE_KEY).join(self.rows().select(*PAGE_KEY), PAGE_KEY, "left_anti").distinct()

    def reading(self, pages: DataFrame, missing: DataFrame, repeated: bool = False) -> DataFrame:
        """What is parsed: the pages that ``missing`` names, where they are scanned.

        Few missing keys are broadcast, so html does not move; in a first run all are missing and nothing is joined. Only where rows
        are ``repeated`` are they brought together, so that a key has one row.
        """
        fresh = pages.join(broadcast_if_small(missing), PAGE_KEY, "left_semi") if not self.rows().isEmpty() else pages
        return fresh.dropDuplicates(PAGE_KEY) if repeated else fresh

    def add(self, pages: DataFrame, keyed: DataFrame) -> int:
        """Parse the pages (html, config and keys) never parsed before; ``keyed`` (written) has their keys. Returns how many were parsed."""
        missing = materialize(self.missing(keyed))
        if missing.isEmpty():
            return 0
        repeated = not keyed.groupBy(*PAGE_KEY).count().where("count > 1").isEmpty()
        seen = Observation()
        fresh = self.reading(pages, missing, repeated).observe(seen, F.count(F.lit(1)).alias("n"))
        read = fresh.select(*PAGE_KEY, both("html", F.col("config")).alias("_page"))
        with arrow_batches(read.sparkSession, BATCH_BYTES):
            read.select(*PAGE_KEY, "_page.*").write.mode("append").parquet(self.path)
        return seen.get["n"]
