"""Quality rules: counts per text, and a hashed n-gram likelihood ratio between trusted and all documents.

DataFrame operations only. Words are runs of anything but ``[\\x20\\x09-\\x0D]``; single words and pairs of neighbours hash
to ``BUCKETS`` buckets. The counts of all documents and of the trusted ones are two multinomials; a bucket's weight is
``log((t + a f) / (f (r + a)))`` with its counts t and r, the share f of trusted n-grams in all of them, and the prior
weight a: a bucket seen rarely tends to 0, whatever the size of the corpus. A text's score is the mean weight of its
n-grams, so its length does not matter; every text is kept or not by one fixed threshold.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: Rows of the weight table, hence the bound of what is broadcast (16 bytes each).
BUCKETS = 1 << 18
PRIOR = 20.0
THRESHOLD = -0.15
#: The trusted multinomial is fitted on about so many labelled documents at most, drawn by a hash of their ids.
TRUSTED_DOCUMENTS = 50_000
MIN_WORDS = 50
WINDOW = 3
_LONGS = "array<bigint>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text; none if it is null."""
    return F.coalesce(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""), F.array().cast("array<string>"))


def _windows(hashes: Column, n: int) -> Column:
    """A hash for every ``n`` neighbours; ``hashes`` is looked up at every place, so it has to be a value, not an expression."""
    count = F.size(hashes) - (n - 1)
    at = lambda i, k: F.get(hashes, i + k)
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.xxhash64(*(at(i, k) for k in range(n))))).otherwise(F.array().cast(_LONGS))


def n_repeat_words(hashes: Column) -> Column:
    return _let(hashes, _n_repeat_words)


def _n_repeat_words(hashes: Column) -> Column:
    """Words that lie in a window of three found twice or more, from the hashes of a text's words.

    A window's hash and place first share one long: the lower bits hold the place, the others what fits of the hash, so that
    a plain sort brings equal windows together. Only windows that have a neighbour there are then compared by the whole hash,
    so that a text's length does not decide how exact its count is.
    """
    size = F.size(hashes)
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")

    def of(v: Column) -> Column:
        packed = F.zip_with(v.windows, F.sequence(zero, F.size(v.windows).cast("long") - 1), lambda h, i: F.call_function("shiftleft", h, v.bits).bitwiseOR(i))
        # most texts repeat no window and need no sort
        once = F.size(F.array_distinct(v.windows)) == F.size(v.windows)
        return F.when(once, zero).otherwise(_let(F.sort_array(packed), lambda s: alike(v, s)))

    def alike(v: Column, s: Column) -> Column:
        prefix = lambda x: F.call_function("shiftrightunsigned", x, v.bits)
        place = lambda x: x.bitwiseAND(F.call_function("shiftleft", one, v.bits) - 1)
        whole = lambda x: F.struct(F.get(v.windows, place(x).cast("int")).alias("hash"), place(x).alias("place"))
        return _let(F.sort_array(F.transform(_with_neighbours(s, prefix), whole)), covered)

    def covered(s: Column) -> Column:
        again = F.sort_array(F.transform(_with_neighbours(s, lambda x: x.hash), lambda x: x.place))
        start = F.struct(zero.alias("n"), zero.alias("end"))
        return F.aggregate(again, start, lambda a, p: F.struct((a.n + p + WINDOW - F.greatest(p, a.end)).alias("n"), (p + WINDOW).alias("end")))["n"]

    enough = size >= WINDOW
    values = F.struct(_windows(hashes, WINDOW).alias("windows"), _place_bits(size).alias("bits"))
    return F.when(enough, _let(values, of)).otherwise(zero)


def _place_bits(size: Column) -> Column:
    """The bits that the places of ``size`` words need."""
    return F.when(size > 1, F.ceil(F.log2(size.cast("double") + 1)).cast("int")).otherwise(F.lit(1))


def _with_neighbours(ordered: Column, key: Callable[[Column], Column]) -> Column:
    """The elements of a sorted array whose key is that of the element before or after."""
    same = lambda x, i: F.coalesce(key(x) == key(F.get(ordered, i)), F.lit(False))
    return F.filter(ordered, lambda x, i: same(x, i - 1) | same(x, i + 1))


def counts(docs: DataFrame, carry: list[str]) -> DataFrame:
    """``carry`` columns, the counts of every text, and ``hashes`` of its words. Null and empty texts have no words."""
    split = docs.select(*carry, "text", words(F.col("text")).alias("words"))
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    text = F.coalesce("text", F.lit(""))
    hashed = split.select(
        *carry,
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    return hashed.select(*carry, F.size("hashes").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", n_repeat_words(F.col("hashes")).alias("n_repeat_words"), "hashes")


def _buckets(hashes: Column) -> Column:
    """Buckets of all single words and pairs."""
    bucket = lambda h: F.shiftrightunsigned(h, 64 - (BUCKETS.bit_length() - 1)).cast("int")
    return _let(hashes, lambda h: F.concat(F.transform(h, bucket), F.transform(_windows(h, 2), bucket)))


def trusted_ids(labels: DataFrame, limit: int = TRUSTED_DOCUMENTS) -> DataFrame:
    """Distinct ids of documents labelled good and not toxic: all, or about ``limit`` of them by a hash of the id."""
    good = labels.filter("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    n = good.count()
    if n <= limit:
        return good
    return good.filter(F.shiftrightunsigned(F.xxhash64(F.lit("trusted"), "doc_id"), 11) / F.lit(2.0**53) < limit / n)


def fit_weights(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """bucket, weight: at most ``BUCKETS`` rows, from the n-grams of all documents. Without trusted ones all weigh 0."""
    known = docs.select("doc_id", "text").join(F.broadcast(trusted.select("doc_id", F.lit(1).alias("trusted"))), "doc_id", "left")
    grams = known.select("trusted", F.explode(_buckets(F.transform(words(F.col("text")), lambda w: F.xxhash64(w)))).alias("bucket"))
    counted = materialize(grams.groupBy("bucket").agg(F.count("*").alias("r"), F.count("trusted").alias("t")))
    total = counted.agg(F.sum("r").alias("r"), F.sum("t").alias("t")).first()
    share = (total.t or 0) / (total.r or 1)
    weight = F.log((F.col("t") + PRIOR * share) / (share * (F.col("r") + PRIOR))) if share else F.lit(0.0)
    return counted.select("bucket", weight.alias("weight"))


def judge(docs: DataFrame, weights: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every document's counts, ``base_failed``, ``score`` and ``kept``.

    A text without words scores 0 and fails the base rule. Repeated rows get a result each. Other columns are ignored.
    An empty table gives an empty one.
    """
    counted = counts(docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row")), ["row", "doc_id"])
    keys = ["row", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    grams = counted.select(*keys, F.explode_outer(_buckets(F.col("hashes"))).alias("bucket"))
    scored = grams.join(F.broadcast(weights), "bucket", "left").groupBy(*keys).agg(F.coalesce(F.avg("weight"), F.lit(0.0)).alias("score"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.select(*keys[1:], failed.alias("base_failed"), (~failed & (F.col("score") >= threshold)).alias("kept"), "score")


def op7_quality_rules(spark, sf: str) -> DataFrame:
    """All documents judged; the trusted ones are those labelled good and not toxic."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    weights = fit_weights(docs, trusted_ids(spark.read.parquet(f"{sf}/labels.parquet")))
    return judge(docs, weights)
