"""Documents to packed token ids: quality rules, near duplicates, decontamination, mixing, packing."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm.mixing import in_order
from broadsheet.llm.near import one_of_each_class
from broadsheet.llm.packing import pack_tokens
from broadsheet.llm.phrases import contamination
from broadsheet.llm.quality import fit_weights, judge, trusted_ids
from broadsheet.session import materialize


def _same_document(docs: DataFrame, chosen: DataFrame) -> Column:
    """``chosen`` has the column k_id. Rows that share a doc_id are one document: they stay or go together."""
    return docs["doc_id"].eqNullSafe(chosen["k_id"])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    weights = fit_weights(docs, trusted_ids(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    # written, so that its size is known: where it is small, documents do not move
    rejected = materialize(judge(docs, weights).filter("NOT kept").select(F.col("doc_id").alias("k_id")))
    return docs.join(rejected, _same_document(docs, rejected), "left_anti")


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates: the one with the smallest doc_id; repeated rows of it once."""
    return one_of_each_class(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without contamination by benchmark items."""
    dirty = materialize(contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).filter("contaminated").select(F.col("doc_id").alias("k_id")))
    return docs.join(dirty, _same_document(docs, dirty), "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once at least, small sources as often as the weights ask, in the order of the mixture's rows."""
    return in_order(docs)


def _written_place(docs: DataFrame) -> tuple[DataFrame, Column | None]:
    """``docs`` and where its rows stand in the files of the tasks that wrote them. A table that is not of files has no such order."""
    part = F.coalesce(F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).try_cast("long"), F.lit(0))
    try:
        return docs.select("doc_id", "text", (F.shiftleft(part, 40) + F.col("_metadata.row_index")).alias("place")), F.col("place")
    except AnalysisException:
        return docs, None


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of token ids, packed in the order in which the rows of ``docs`` were written; nothing moves."""
    placed, place = _written_place(docs)
    return pack_tokens(placed, place=place)


STAGES = [
    ("quality rules", quality),
    ("MinHash near-dedup", deduplicate),
    ("benchmark decontamination", decontaminate),
    ("mixing sources to target weights", mix),
    ("token-ID / binary output", pack),
]

#: Sketches, the fitted weights and the tokenizer cannot be told in SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
