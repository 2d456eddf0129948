"""The article store: plain Parquet tables that runs only append to.

Every run writes its rows under ``written=<n>``, n being its number, and last of all a row in ``runs``: files without one, left by a run that
failed, are not read, and the next run, which has the same number, replaces them. Articles are also partitioned by the first digits of their id.
Of several rows of an article the one of the latest run is live, so a run writes what changed and nothing else. A batch asks only the partitions
that its ids can be in.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..operators.upsert import KEY
from ..session import empty_table

TABLES = {
    "articles": schemas.ARTICLES,
    "categories": schemas.CATEGORIES,
    "authors": schemas.AUTHORS,
    "images": schemas.IMAGES,
    "state": schemas.STATE,
    "runs": "run bigint, batch string",
    # of walks over streams, see streaming/walk.py: what arrived and was walked, the outcomes, and as of the last batch what is wanted
    "heads": f"walk string, {schemas.HEADS}",
    "walked": "walk string, site string, url string, page_number bigint",
    "counters": "walk string, site string, inserted bigint, updated bigint, skipped bigint, errors bigint",
    "frontier": "walk string, site string, domain string, url string, page_number bigint, cap bigint, done boolean",
    "waiting": f"walk string, {schemas.WAITING}",
}
APPENDED = ["heads", "walked", "counters"]

#: Articles are in 16 to the power of this many partitions per run.
PREFIX_DIGITS = 2


def prefix_of(article_id: str = "article_id") -> Column:
    return F.substring(article_id, 1, PREFIX_DIGITS)


class Store:
    """One writer at a time, as for any folder of Parquet files."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _read(self, table: str) -> DataFrame:
        """An empty typed table until something was written."""
        prefix = ", prefix string" if table == "articles" else ""
        schema = StructType.fromDDL(f"{TABLES[table]}, written bigint{prefix}")
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{table}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return empty_table(self.spark, schema)

    def last_run(self) -> int:
        return self._read("runs").agg(F.max("run").alias("run")).first()["run"] or 0

    def _finished(self, table: str) -> DataFrame:
        return self._read(table).where(F.col("written") <= self.last_run())

    def has_batch(self, batch: str) -> bool:
        return not self._read("runs").where(F.col("batch") == batch).isEmpty()

    def articles(self) -> DataFrame:
        """Live articles. Only those written more than once meet by key; where these are few, no body moves."""
        rows = self._finished("articles")
        several = rows.groupBy(*KEY).agg(F.max("written").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
        newer = several.select(*(F.col(c).alias(f"_{c}") for c in KEY), "last")
        replaced = (F.col("domain") == F.col("_domain")) & (F.col("article_id") == F.col("_article_id")) & (F.col("written") < F.col("last"))
        return rows.join(newer, replaced, "left_anti").drop("written", "prefix")

    def touched(self, ids: DataFrame) -> DataFrame:
        """Keys, hashes and times of the live articles with one of the ``ids`` (article_id, distinct, written); other partitions are not read."""
        prefixes = sorted(r.prefix for r in ids.select(prefix_of().alias("prefix")).distinct().collect())  # 256 at most
        rows = self._finished("articles").where(F.col("prefix").isin(prefixes)).join(ids, "article_id", "left_semi")
        last = F.max_by(F.struct("content_hash", "scraped_at"), "written").alias("last")
        return rows.groupBy(*KEY).agg(last).select(*KEY, "last.content_hash", "last.scraped_at")

    def lookup(self, name: str) -> DataFrame:
        return self._finished(name).drop("written")

    def of_walk(self, name: str, walk: str) -> DataFrame:
        """A walk's rows: all that were appended, or those of its last batch. Every batch of a walk writes its frontier."""
        mine = self._finished(name).where(F.col("walk") == walk)
        if name not in APPENDED:
            last = self._finished("frontier").where(F.col("walk") == walk).agg(F.max("written").alias("n")).first()["n"]
            mine = mine.where(F.col("written") == (last or 0))
        return mine.drop("walk", "written")

    def state(self) -> DataFrame:
        """Small, so every run writes it whole."""
        return self._read("state").where(F.col("written") == self.last_run()).drop("written")

    def begin(self) -> Run:
        return Run(self, self.last_run() + 1)


class Run:
    """The rows of one run; ``put`` writes a table, ``commit`` makes all of them count."""

    def __init__(self, store: Store, number: int):
        self.store, self.number, self.has_state = store, number, False

    def put(self, table: str, rows: DataFrame) -> DataFrame:
        """Write the rows of one table, and read them back from there. Articles are brought together by partition, in files of a fair size."""
        path = f"{self.store.root}/{table}/written={self.number}"
        writer = rows.write
        if table == "articles":
            writer = rows.withColumn("prefix", prefix_of()).hint("rebalance", "prefix").write.partitionBy("prefix")
        writer.mode("overwrite").parquet(path)
        self.has_state |= table == "state"
        schema = StructType.fromDDL(TABLES[table])
        return self.store.spark.read.schema(schema).parquet(path).select(*schema.names)

    def commit(self, batch: str = "") -> int:
        if not self.has_state:
            self.put("state", self.store.state())
        row = self.store.spark.range(0, 1, 1, 1).select(F.lit(self.number).cast("bigint").alias("run"), F.lit(batch).alias("batch"))
        row.write.mode("overwrite").parquet(f"{self.store.root}/runs/written={self.number}")
        return self.number
