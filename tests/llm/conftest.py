import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    """A maker of documents tables, with columns whose names clash with those the operators use inside."""

    def make(rows, extra=True):
        frame = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
        if not extra:
            return frame
        from pyspark.sql import functions as F

        names = ["words", "key", "row", "digest", "node", "size", "place", "block", "tokens", "kept", "score", "shard", "bucket", "line_no", "text_hash"]
        return frame.withColumns({n: F.lit(f"{n} of the input") for n in names})

    return make


@pytest.fixture(scope="session")
def small(tmp_path_factory):
    """The folder of the shared small tables."""
    return "/root/testdata/sf0.001"
