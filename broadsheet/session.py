"""Session defaults and the shared work folder."""

from __future__ import annotations

import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def build_session(app: str = "broadsheet", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; any of them can be overridden.

    AQE sizes the shuffles and splits skewed joins. Arrow batches are bounded by bytes, as one page
    can be large. The checkpoint folder is left to the cluster.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
        "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return ship(builder.getOrCreate())


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable on the executors, as ``--py-files`` would."""
    package = Path(__file__).parent
    if not any(Path(f).name.startswith(f"{package.name}-") for f in spark.sparkContext.listFiles):
        base = f"{tempfile.mkdtemp(prefix='broadsheet-')}/{package.name}-{uuid.uuid4().hex[:8]}"
        spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", package.parent, package.name))
    return spark


def work_dir(spark: SparkSession) -> str:
    """This application's part of the shared folder that the cluster names, so that a retention rule can tell old ones.

    A temporary folder only in local mode, where none is set.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="broadsheet-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/{spark.sparkContext.applicationId}"


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    """A typed table without rows. ``createDataFrame`` would make it with Python workers, which then stay on the executors."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


@contextmanager
def arrow_batches(spark: SparkSession, max_bytes: int) -> Iterator[None]:
    """What is run within sends Python so many bytes at a time; afterwards the session has its own setting again."""
    before = spark.conf.get(ARROW_BYTES, None)
    spark.conf.set(ARROW_BYTES, str(max_bytes))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(ARROW_BYTES)
        else:
            spark.conf.set(ARROW_BYTES, before)


def materialize_counted(df: DataFrame, condition: str) -> tuple[DataFrame, int]:
    """``materialize``, and how many rows meet the condition, counted while they are written."""
    seen = Observation()
    table = materialize(df.observe(seen, F.count_if(F.expr(condition)).alias("n")))
    return table, seen.get["n"]


def materialize(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/work-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
