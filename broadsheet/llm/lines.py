"""Line duplicates by levelled sorted runs of line hashes.

A run holds one row per line key of one or more batches: its 128-bit hash, the number of documents with it and the
document that keeps its lines. Runs are tables bucketed and sorted by the hash, so that joining a batch with them moves the
batch only. Batches come from the largest doc_ids down: a batch anti-joins the runs, and the keys that none of them has are kept
by this batch's largest doc_id; keys that a run has only add to the number of documents. The batch becomes a run of level 0, and
``FAN`` runs of a level are merged into one of the next, so the number of runs grows with the logarithm of the batches.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, work_dir

FAN = 2
BATCHES = 4
MIN_CHARS = 40
MIN_DOCUMENTS = 5
_WHITE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["k1", "k2"]


def split_lines(text: Column) -> Column:
    """The lines of a text; null or empty: one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """Stripped of ASCII white space at both ends, with A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(_WHITE)), _UPPER, _LOWER)


class LineRuns:
    """Runs of line keys, under the shared work folder."""

    def __init__(self, spark: SparkSession, fan: int = FAN, buckets: int | None = None):
        self.spark, self.fan = spark, fan
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name = f"line_runs_{uuid.uuid4().hex}"
        self.folder = f"{work_dir(spark)}/{self.name}"
        self.levels: list[list[str]] = [[]]
        self._written = 0

    def _write(self, rows: DataFrame) -> str:
        table = f"{self.name}_{self._written}"
        self._written += 1
        rows.select(*KEY, "n_docs", "last_doc").write.bucketBy(self.buckets, *KEY).sortBy(*KEY).option("path", f"{self.folder}/{table}").saveAsTable(table)
        return table

    def _merged(self, tables: list[str]) -> DataFrame:
        # read as plain files: Spark 4.1 takes a union of bucketed tables for bucketed, and groups it wrongly
        read = self.spark.read.schema("k1 long, k2 long, n_docs long, last_doc long")
        return self._summed(read.parquet(*(f"{self.folder}/{t}" for t in tables)))

    def _summed(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.buckets, *KEY).groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))

    def tables(self) -> list[str]:
        return [t for level in self.levels for t in level]

    def unseen(self, keys: DataFrame) -> DataFrame:
        """The rows of ``keys`` (k1, k2, ...) whose key is in no run."""
        return reduce(lambda rows, table: rows.join(self.spark.table(table), KEY, "left_anti"), self.tables(), keys)

    def add(self, keys: DataFrame) -> None:
        """Adds (k1, k2, doc_id) of a batch of documents, all smaller than the earlier ones; merges full levels."""
        batch = keys.select(*KEY, "doc_id").distinct().groupBy(*KEY).agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))
        batch = materialize(batch)
        kept_here = self.unseen(batch).select(*KEY, F.lit(0).cast("long").alias("n_docs"), "last_doc")
        counted = batch.select(*KEY, "n_docs", F.lit(None).cast(batch.schema["last_doc"].dataType).alias("last_doc"))
        self.levels[0].append(self._write(self._summed(kept_here.unionByName(counted))))
        for i, level in enumerate(self.levels):
            if len(level) < self.fan:
                break
            if i + 1 == len(self.levels):
                self.levels.append([])
            self.levels[i + 1].append(self._write(self._merged(level)))
            self.levels[i] = []

    def totals(self) -> DataFrame:
        """k1, k2, n_docs, last_doc over all runs."""
        return self._merged(self.tables())

    def close(self) -> None:
        """Forgets the tables' names; their files stay under the retention of the shared folder."""
        for i in range(self._written):
            self.spark.sql(f"DROP TABLE IF EXISTS {self.name}_{i}")


def _long_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """doc_id, text_hash, line_no (from 0) and key of every line whose key has ``min_chars`` code points."""
    lines = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(split_lines(F.col("text"))).alias("line_no", "line"))
    keyed = lines.select("doc_id", "text_hash", "line_no", line_key(F.col("line")).alias("key")).filter(F.length("key") >= min_chars)
    return keyed.select("doc_id", "text_hash", "line_no", F.xxhash64("key").alias("k1"), F.xxhash64(F.lit("second"), "key").alias("k2"))


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_lines, n_dropped and the text that is left, for every row of ``docs`` (doc_id, text).

    A key of at least ``min_chars`` code points in at least ``min_documents`` documents loses its lines everywhere but in
    the largest doc_id. Documents come in ``batches`` ranges of doc_id. A document is a doc_id: rows that repeat one count
    once and are treated alike; rows without doc_id count as one document, which is never the largest. A null or empty text is one
    empty line. Other columns are ignored; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    ids = docs.select("doc_id", "text")
    shares = F.array(*(F.lit(i / batches) for i in range(1, batches))) if batches > 1 else None
    bounds = [] if shares is None else ids.agg(F.percentile_approx("doc_id", shares, 100).alias("at")).first().at or []
    batch = reduce(lambda n, b: n + F.coalesce(F.col("doc_id") > b, F.lit(False)).cast("int"), bounds, F.lit(0))
    path = f"{work_dir(spark)}/lines-{uuid.uuid4().hex}"
    _long_lines(ids, min_chars).withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    lines = spark.read.schema("doc_id long, text_hash long, line_no int, k1 long, k2 long, batch int").parquet(path)
    runs = LineRuns(spark)
    for i in range(len(bounds), -1, -1):
        runs.add(lines.filter(F.col("batch") == i))
    # written, so that this side does not pin the join to the runs' buckets and a frequent line can be split
    heavy = materialize(runs.totals().filter(F.col("n_docs") >= min_documents).select(*KEY, "last_doc"))
    runs.close()
    lost = lines.join(heavy, KEY).filter(~F.col("doc_id").eqNullSafe(F.col("last_doc")))
    lost = lost.groupBy("doc_id", "text_hash").agg(F.collect_set("line_no").alias("lost"))
    rows = ids.withColumn("text_hash", F.xxhash64("text")).alias("a")
    lost = lost.withColumnsRenamed({"doc_id": "lost_id", "text_hash": "lost_hash"})
    joined = rows.join(lost, F.col("doc_id").eqNullSafe(F.col("lost_id")) & (F.col("text_hash") == F.col("lost_hash")), "left")
    split = joined.select("doc_id", split_lines(F.col("text")).alias("lines"), F.coalesce("lost", F.array().cast("array<int>")).alias("lost"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "lost")
    return split.select(
        "doc_id", F.size("lines").cast("long").alias("n_lines"), F.size("lost").cast("long").alias("n_dropped"),
        F.when(F.size("lost") == 0, F.array_join("lines", "\n")).otherwise(F.array_join(F.transform(kept, lambda i: F.get(F.col("lines"), i)), "\n")).alias("text"),
    )


def op3_line_runs(spark, sf: str) -> DataFrame:
    """The lines left of every document, as a digest."""
    left = drop_repeated_lines(spark.read.parquet(f"{sf}/documents.parquet"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP3_SQL = f"""
WITH lines AS (
  SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)),
keyed AS (
  SELECT doc_id, i, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{_UPPER}', '{_LOWER}') AS key FROM lines),
heavy AS (
  SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {MIN_DOCUMENTS}),
marked AS (
  SELECT k.doc_id, k.i, k.line, h.key IS NOT NULL AND k.doc_id <> h.last_doc AS lost FROM keyed k LEFT JOIN heavy h ON k.key = h.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
