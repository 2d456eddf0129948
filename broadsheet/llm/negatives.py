"""Hard negatives by Fagin's threshold algorithm.

Candidates stand in blocks. A block has one list per dimension, its members sorted by that component, and the components of all of them. For
an anchor the lists are read in step, from the end that its component's sign asks for; a member seen for the first time is scored whole, by random
access, as an integer inner product. No member that no list has shown can score more than the threshold, which is the sum of the
anchor's components times the values at the lists' reading places. A window takes scores from ``low`` to ``high`` and keeps the ``k`` best;
reading stops once the threshold is strictly below the kth score of every window (or below ``low`` where a window has
fewer), so ties are all seen. A first pass has one window per anchor, the rows of its label; a second has one per positive.

Blocks of candidates meet blocks of anchors by block number: anchors are the stated query set, and each task holds one block of both. The best of
every block are merged by a window over blocks times ``k`` rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
#: A negative scores from so many hundredths of its positive's score up to that score.
LEAST_SHARE = 80
#: Members of a block: a 64th of all within these bounds, so that many tasks share them and one holds them.
BLOCK_ROWS = (4096, 65536)
ANCHOR_ROWS = 512
#: The share of the lists that is read first; each further step doubles the depth.
FIRST_STEP = 16
#: Sums up to these are whole numbers in 32 and 64 bits of floating point.
_EXACT = ((1 << 24, np.float32), (1 << 53, np.float64))
_LOW, _HIGH = -(1 << 63), (1 << 63) - 1

_CANDIDATES = "block long, dims int, ids binary, labels binary, members binary, lists binary"
_FOUND = "anchor long, slot int, vec_id long, score long"


def quantised(vector: Column | str) -> Column:
    """floor(256 * x) of each component, as doubles, which hold it exactly; null where a component is null or not finite."""
    parts = F.transform(F.col(vector) if isinstance(vector, str) else vector, lambda x: x.cast("double"))
    finite = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    # multiplied and floored as doubles: no component overflows
    return F.when(finite, F.transform(parts, lambda x: F.when(F.abs(x) < 2.0**44, F.floor(x * SCALE).cast("double")).otherwise(x * SCALE)))


def _matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """A row per vector; shorter ones are filled up with zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy(zero_copy_only=False)) if len(lists) else np.zeros(0, int)
    out = np.zeros((len(lists), dims))
    out[np.arange(dims) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _block(key: tuple, rows: pa.Table) -> pa.Table:
    """One row per block: its members (vec_id, label, components), and the members' numbers in the order of each component."""
    dims = max(1, max(len(x) for x in rows.column("vector")))
    members = _matrix(rows.column("vector"), dims)
    lists = np.argsort(members, axis=0, kind="stable").astype(np.int32)
    schema = pa.schema([("block", pa.int64()), ("dims", pa.int32()), *((c, pa.binary()) for c in ("ids", "labels", "members", "lists"))])
    column = lambda c: rows.column(c).to_numpy().astype(np.int64).tobytes()
    small = np.abs(members).max(initial=0) < 2**15
    row = [key[0].as_py(), dims, column("vec_id"), column("label"), (members.astype(np.int16) if small else members).tobytes(), lists.T.tobytes()]
    return pa.table([[x] for x in row], schema=schema)


class Block:
    """A block's members and sorted lists."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, members: np.ndarray, lists: np.ndarray):
        self.ids, self.labels, self.lists = ids, labels, lists
        self.members, self.largest = members, float(np.abs(members).max(initial=0))
        self.cast: dict = {}

    @staticmethod
    def read(row: dict) -> Block:
        ids = np.frombuffer(row["ids"], np.int64)
        dims = row["dims"]
        kind = np.int16 if len(row["members"]) == 2 * dims * len(ids) else np.float64
        members = np.frombuffer(row["members"], kind).reshape(len(ids), dims)
        return Block(ids, np.frombuffer(row["labels"], np.int64), members, np.frombuffer(row["lists"], np.int32).reshape(dims, len(ids)))

    def scores(self, anchor: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Exact inner products of some members; sums beyond 64 bits are held at its ends."""
        most = float(np.abs(anchor).sum()) * self.largest
        for bound, kind in _EXACT:
            if most < bound:
                if kind not in self.cast:
                    self.cast[kind] = self.members.astype(kind)
                return (self.cast[kind][which] @ anchor.astype(kind)).astype(np.int64)
        whole = np.array([int(x) for x in anchor], dtype=object)
        rows = [sum(int(x) * a for x, a in zip(row, whole)) for row in self.members[which].tolist()]
        return np.array([min(max(s, _LOW), _HIGH) for s in rows], np.int64)

    def threshold(self, anchor: np.ndarray, places: list[tuple[int, int]], depth: int) -> float:
        """The most that a member scores which no list has shown among its first ``depth``; rounded up, as sums of doubles are not exact."""
        at = depth - 1
        terms = [float(self.members[self.lists[d, at if sign < 0 else -1 - at], d]) * float(anchor[d]) for d, sign in places]
        total = sum(terms)
        return total + 1e-12 * sum(map(abs, terms)) if max(map(abs, terms), default=0) > 2**45 else total


class Scoring:
    """The best ``k`` members of each window of an anchor, kept while members are seen."""

    def __init__(self, windows: list[tuple[int, int]], k: int):
        self.windows, self.k = windows, k
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in windows]

    def see(self, ids: np.ndarray, scores: np.ndarray) -> None:
        for w, (low, high) in enumerate(self.windows):
            fits = (scores >= low) & (scores <= high)
            if fits.any():
                s, i = np.append(self.best[w][0], scores[fits]), np.append(self.best[w][1], ids[fits])
                order = np.lexsort((i, ~s))[: self.k]
                self.best[w] = s[order], i[order]

    def done(self, threshold: float) -> bool:
        """Whether no unseen member can change a window."""
        return all(threshold < (int(s[-1]) if len(s) == self.k else low) for (s, _), (low, _) in zip(self.best, self.windows))


def threshold_search(
    block: Block, anchor: np.ndarray, takes: np.ndarray, windows: list[tuple[int, int]], k: int, first_step: int = FIRST_STEP
) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """For each window the scores and ids of its best ``k`` members among those that ``takes`` allows, and how deep the lists were read."""
    kept, n = Scoring(windows, k), len(block.ids)
    # a list whose component of the anchor is 0 adds nothing, so it is not read
    places = [(d, 1 if x > 0 else -1) for d, x in enumerate(anchor[: len(block.lists)]) if x]
    anchor = np.append(anchor, np.zeros(max(0, block.members.shape[1] - len(anchor))))[: block.members.shape[1]]
    if not places:
        everyone = np.flatnonzero(takes)
        kept.see(block.ids[everyone], np.zeros(len(everyone), np.int64))
        return kept.best, n
    seen, depth = np.zeros(n, bool), 0
    while depth < n:
        further = min(n, 2 * depth or -(-n // first_step))
        shown = np.concatenate([block.lists[d, depth:further] if sign < 0 else block.lists[d, n - further : n - depth] for d, sign in places])
        fresh = np.zeros(n, bool)
        fresh[shown] = True
        fresh &= ~seen
        seen |= fresh
        which = np.flatnonzero(fresh & takes)
        if len(which):
            kept.see(block.ids[which], block.scores(anchor, which))
        depth = further
        if kept.done(block.threshold(anchor, places, depth)):
            break
    return kept.best, depth


def _search(same_label: bool, k: int):
    """Over pairs of a block of candidates and a block of anchors (anchor, vec_id, label, vector, windows)."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                block = Block.read({c: row.column(c)[0].as_py() for c in ("dims", "ids", "labels", "members", "lists")})
                for some in _found(block, row.column("anchors")[0].as_py()):
                    yield some

    def _found(block: Block, anchors: list[dict]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for a in anchors:
            vector = np.array(a["vector"], dtype=np.float64)
            takes = (block.labels == a["label"]) == same_label
            if same_label:
                padded = np.append(vector, np.zeros(max(0, block.members.shape[1] - len(vector))))
                for m in np.flatnonzero(takes & (block.ids == a["vec_id"])):
                    # the anchor itself; another row may share its vec_id
                    takes[m] = not (np.array_equal(block.members[m], padded[: block.members.shape[1]]) and not padded[block.members.shape[1] :].any())
            windows = [(w["low"], w["high"]) for w in a["windows"]]
            best, _ = threshold_search(block, vector, takes, windows, k)
            out += [(a["anchor"], w["slot"], int(v), int(s)) for w, (scores, ids) in zip(a["windows"], best) for s, v in zip(scores, ids)]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64()))], names=["anchor", "slot", "vec_id", "score"])

    return search


def _best(blocks: DataFrame, anchors: DataFrame, n_blocks: int, same_label: bool, k: int) -> DataFrame:
    """anchor, slot, rank, vec_id, score: the first ``k`` of every window over all blocks. ``anchors``: anchor, vec_id, label, vector, windows."""
    packed = anchors.groupBy(F.floor(F.col("anchor") / ANCHOR_ROWS).alias("part")).agg(
        F.collect_list(F.struct("anchor", "vec_id", "label", "vector", "windows")).alias("anchors")
    )
    sent = packed.select("anchors", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))).alias("block"))
    # Spark takes what is sent for as small as the anchors, though it has them once per block, and would broadcast it; so this join is always a merge,
    # which keeps one block at a time. The parts are not left to their size, as a block of few MB is searched for long.
    sent, dealt = (x.repartition(2 * n_blocks, "block") for x in (sent, blocks))
    pairs = sent.hint("merge").join(dealt, "block").select(*(c for c in blocks.columns if c != "block"), "anchors")
    found = pairs.mapInArrow(_search(same_label, k), _FOUND)
    rank = F.row_number().over(Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def _numbered(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` written with ``anchor``, gapless from 0, and how many there are: numbers per part of the table, shifted."""
    parts = materialize(rows.withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()))
    sizes = parts.groupBy("part").agg(F.count("*").alias("n"))
    shifts = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("shift"))
    in_part = F.col("at") - F.shiftleft(F.col("part").cast("long"), 33) + F.col("shift")
    return parts.join(shifts, "part").select(in_part.alias("anchor"), *rows.columns), parts.count()


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, least_share: int = LEAST_SHARE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for ``vectors`` (vec_id long, label int, vector: ``quantised``).

    Rows with a null label, vec_id or vector take no part. Rows that repeat vec_id, label and vector are one row; rows that share a vec_id only
    are rows of their own. Equal scores go by the smaller vec_id. Of rows with equal label and vector only the first can ever be chosen, one more than
    a window takes, so very many copies are no more than those. Vectors of unequal length are compared as if the shorter went on with zeros; a positive
    with a score below 0 has no negatives. An empty table, or one without anchors, gives no rows; other columns are ignored.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "vector", is_anchor.alias("is_anchor"))
    rows = materialize(rows.dropna(subset=["vec_id", "label", "vector"]).dropDuplicates(["vec_id", "label", "vector"]))
    copies = Window.partitionBy("label", "vector").orderBy("vec_id")
    first = rows.withColumn("copy", F.row_number().over(copies)).filter(F.col("copy") <= max(positives + 1, negatives)).select("vec_id", "label", "vector")
    candidates = materialize(first)
    n = candidates.count()
    n_blocks = max(1, -(-n // min(max(n // 64, BLOCK_ROWS[0]), BLOCK_ROWS[1])))
    dealt = candidates.withColumn("block", F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(n_blocks)).cast("long"))
    blocks = materialize(dealt.groupBy("block").applyInArrow(_block, _CANDIDATES))

    anchors, n_anchors = _numbered(rows.filter("is_anchor").drop("is_anchor"))
    anchors = materialize(anchors)
    everything = F.array(F.struct(F.lit(0).alias("slot"), F.lit(_LOW).alias("low"), F.lit(_HIGH).alias("high")))
    near = materialize(_best(blocks, anchors.withColumn("windows", everything), n_blocks, True, positives))

    # of negatives, 100 times the score: share * positive <= 100 * score <= 100 * positive
    low = F.ceil(F.col("score").cast("decimal(38,0)") * least_share / F.lit(100)).cast("long")
    window = F.struct(F.col("rank").alias("slot"), low.alias("low"), F.col("score").alias("high"))
    windows = near.filter("score >= 0").groupBy("anchor").agg(F.collect_list(window).alias("windows"))
    far = _best(blocks, anchors.join(windows, "anchor"), n_blocks, False, negatives)
    named = near.join(anchors.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
    pairs = named.select("anchor", F.col("rank").alias("slot"), "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return pairs.join(far, ["anchor", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def op11_threshold_negatives(spark, sf: str) -> DataFrame:
    """Hard negatives for every hundredth row of embeddings; every seventh row's label is moved on by one."""
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.select("vec_id", label.alias("label"), quantised("embedding").alias("vector")), F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH quantised AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM quantised a JOIN quantised b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""
