"""Outcomes of fetch attempts that arrive late and in any order."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..operators.joins import broadcast_if_small
from ..operators.policy import attempt_ends
from ..session import materialize

OUTCOMES = "url string, fetch string, attempts int, status int, final boolean, revision int"
ATTEMPT = "struct<place: array<bigint>, batch: bigint, success: boolean, ends: boolean, status: int>"
HELD = f"url string, attempts array<{ATTEMPT}>, told struct<fetch: string, attempts: int, status: int, final: boolean>, revision int, revised boolean, batch bigint"


def _settled(attempts: Column, max_retries: int) -> Column:
    """fetch, attempts, status, final of a URL's first attempts, in their order."""
    ending = F.array_position(F.transform(attempts, lambda a: a["ends"]), True)
    number = F.when(ending > 0, ending).otherwise(F.size(attempts)).cast("int")
    last = F.element_at(attempts, number)
    return F.struct(
        F.when((ending > 0) & last["success"], "ok").otherwise("failed").alias("fetch"),
        number.alias("attempts"),
        last["status"].alias("status"),
        ((ending > 0) | (number == max_retries)).alias("final"),
    )


def _held(spark: SparkSession, folder: str, number: int) -> DataFrame:
    """What the batches before ``number`` wrote of the URLs that they changed."""
    try:
        rows = spark.read.schema(HELD).parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], HELD)
    return rows.where(F.col("batch") < number)


def _merge(came: DataFrame, held: DataFrame, max_retries: int) -> DataFrame:
    """The rows of ``held`` that a batch changes. ``came`` (written): url, attempts, the first ones of the batch, one row per URL."""
    asked = broadcast_if_small(came.select(F.col("url").alias("_url")))
    last = F.max_by(F.struct("attempts", "told", "revision"), "batch").alias("held")
    known = held.join(asked, F.col("url").eqNullSafe(F.col("_url")), "left_semi").groupBy(F.col("url").alias("_url")).agg(last)
    both = came.join(known, F.col("url").eqNullSafe(F.col("_url")), "left")
    # an attempt beyond the first few never counts, whatever arrives later
    before = F.coalesce("held.attempts", F.array().cast(f"array<{ATTEMPT}>"))
    merged = both.withColumn("attempts", F.slice(F.sort_array(F.concat(before, "attempts")), 1, max_retries)).where(~F.col("attempts").eqNullSafe(before))
    told = merged.withColumn("told", _settled(F.col("attempts"), max_retries))
    revised = ~F.col("told").eqNullSafe(F.col("held.told"))
    return told.select("url", "attempts", "told", (F.coalesce("held.revision", F.lit(0)) + revised.cast("int")).alias("revision"), revised.alias("revised"))


def stream_fetch_outcomes(log: DataFrame, order: list[Column], folder: str, checkpoint: str, max_retries: int = 3) -> StreamingQuery:
    """Follow a stream of attempts (url, status, error) and stop when all that is there has been read; ``fetch_outcomes`` as attempts arrive.

    ``order``: whole numbers that place an attempt among those of its URL. The state of a URL is its first ``max_retries`` attempts and what was
    told of them; each batch appends that of the URLs it changes to a table beside the checkpoint's own files, and asks it for its URLs only. A
    revision is written when the outcome changes: ``final`` once the series has ended, and corrected if an earlier attempt arrives after all. A batch
    writes its own parts of both, from those of the batches before it, so one that is repeated after a failure replaces what it wrote.
    """
    success, ends = attempt_ends()
    place = F.array(*(c.cast("bigint") for c in order))
    attempts = log.select("url", place.alias("place"), success.alias("success"), ends.alias("ends"), F.col("status").cast("int").alias("status"))
    first = F.row_number().over(Window.partitionBy("url").orderBy("place", "success", "ends", "status"))
    attempt = F.struct("place", "batch", "success", "ends", "status")

    def write(batch: DataFrame, number: int) -> None:
        spark, state = batch.sparkSession, f"{checkpoint}/held"
        tried = batch.withColumn("batch", F.lit(number).cast("bigint")).withColumn("number", first).where(F.col("number") <= max_retries)
        came = materialize(tried.groupBy("url").agg(F.collect_list(attempt).alias("attempts")))
        _merge(came, _held(spark, state, number), max_retries).write.mode("overwrite").parquet(f"{state}/batch={number}")
        changed = _held(spark, state, number + 1).where((F.col("batch") == number) & F.col("revised"))
        changed.select("url", "told.*", "revision").write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return attempts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """url, fetch, attempts, status: the last revision of each."""
    last = F.max_by(F.struct("fetch", "attempts", "status"), "revision").alias("last")
    return spark.read.schema(f"{OUTCOMES}, batch int").parquet(folder).groupBy("url").agg(last).select("url", "last.*")
