"""A positional inverted index of a corpus, and exact phrase and proximity search in it.

The index is cut by documents: a segment holds about ``SEGMENT_BYTES`` of whole texts, and for each of its terms the sorted
positions of all its occurrences. Segments are rows of a Parquet table; building and searching them needs no shuffle, and a
frequent term is spread over all segments. Search terms are looked up in a segment's term list; the posting lists of a
phrase, each moved by its word's offset, are intersected from the rarest to the most frequent, until nothing is left.
Words are compared by 64-bit hashes. Test items are sent to the tasks in blocks of ``ITEM_BLOCK_BYTES``, one after the other:
each block is a job that writes its matches, so driver and tasks hold one block at a time, however large the benchmark is.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, work_dir
from .words import LOWER, NOT_ALNUM, hash_words, text_words

SEGMENT_BYTES = 2 << 20
ITEM_BLOCK_BYTES = 4 << 20
WINDOW = 13
INDEX = "first_key long, doc_ids array<long>, n_words array<long>, terms binary, ends binary, positions binary"
MATCH = "doc_key long, item_id string, kind string, start long, length long"


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
    for batch in batches:
        sizes = np.cumsum([0, *(batch.column("size").to_pylist())])
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(sizes, sizes[i] + SEGMENT_BYTES, side="right")) - 1)
            part = batch.slice(i, j - i)
            hashes, counts = text_words(part.column("text"), NOT_ALNUM, lower=True)
            # one free position after every document keeps phrases inside it
            places = np.arange(len(hashes), dtype=np.uint32) + np.repeat(np.arange(len(counts), dtype=np.uint32), counts)
            order = np.argsort(hashes, kind="stable")
            ordered = hashes[order]
            new = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, np.int64)
            ends = np.append(new[1:], len(ordered)).astype(np.uint32) if len(ordered) else np.zeros(0, np.uint32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([key], pa.int64()), pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())), pa.array([counts.tolist()], pa.list_(pa.int64())),
                    pa.array([ordered[new].tobytes()], pa.binary()), pa.array([ends.tobytes()], pa.binary()), pa.array([places[order].tobytes()], pa.binary()),
                ],
                names=["first_key", "doc_ids", "n_words", "terms", "ends", "positions"],
            )
            key += j - i
            i = j


def build_index(docs: DataFrame) -> DataFrame:
    """The index of ``docs`` (doc_id long, text), written to the shared folder. Null texts have no words."""
    rows = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size"))
    return materialize(rows.mapInArrow(_segments, INDEX))


def indexed_documents(index: DataFrame) -> DataFrame:
    """doc_key, doc_id, n_words: one row per indexed row."""
    rows = index.select("first_key", F.posexplode(F.arrays_zip("doc_ids", "n_words")).alias("i", "d"))
    return rows.select((F.col("first_key") + F.col("i")).alias("doc_key"), F.col("d.doc_ids").alias("doc_id"), F.col("d.n_words").alias("n_words"))


class Items:
    """A block of test items: their windows as indices into the list of their distinct terms."""

    def __init__(self, ids: list[str], texts: list[str], window: int):
        words = [hash_words(LOWER[np.frombuffer((t or "").encode(), np.uint8)], np.zeros(1, np.int64), NOT_ALNUM)[0] for t in texts]
        self.ids = ids
        self.terms, flat = np.unique(np.concatenate([np.zeros(0, np.uint64), *words]), return_inverse=True)
        self.windows: list[tuple[int, np.ndarray]] = []
        at = 0
        seen: dict[bytes, int] = {}
        self.owners: list[list[int]] = []
        for item, w in enumerate(words):
            mine = flat[at : at + len(w)]
            at += len(w)
            size = min(window, len(w))
            for k in range(len(w) - size + 1 if size else 0):
                part = mine[k : k + size]
                n = seen.setdefault(part.tobytes(), len(self.windows))
                if n == len(self.windows):
                    self.windows.append((size, part))
                    self.owners.append([])
                self.owners[n].append(item)


def _runs(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of intervals as maximal intervals; touching ones join only where they overlap."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    head = np.append(True, starts[1:] > ends[:-1])
    last = np.append(np.flatnonzero(head)[1:] - 1, len(starts) - 1)
    return starts[head], ends[last]


def _within(places: np.ndarray, others: np.ndarray, slop: int, doc_start: np.ndarray) -> np.ndarray:
    """Which ``places`` have one of ``others`` at most ``slop`` away in the same document."""
    at = np.searchsorted(others, places)
    doc = lambda x: np.searchsorted(doc_start, x, side="right")
    near = lambda x: (np.abs(x - places) <= slop) & (doc(x) == doc(places))
    return near(others[np.minimum(at, len(others) - 1)]) | near(others[np.maximum(at - 1, 0)])


def _search(items: Items, slop: int | None):
    sizes = np.array([n for n, _ in items.windows], dtype=np.int64)
    flat = np.concatenate([np.zeros(0, np.int64), *(w for _, w in items.windows)]).astype(np.int64)
    heads = np.cumsum(np.append(0, sizes))[:-1].astype(np.int64)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield from one({c: batch.column(c)[row] for c in batch.schema.names})

    def one(row: dict) -> Iterator[pa.RecordBatch]:
        terms = np.frombuffer(row["terms"].as_buffer(), np.uint64)
        if not len(terms) or not len(heads):
            return
        ends = np.frombuffer(row["ends"].as_buffer(), np.uint32).astype(np.int64)
        positions = np.frombuffer(row["positions"].as_buffer(), np.uint32)
        at = np.minimum(np.searchsorted(terms, items.terms), len(terms) - 1)
        begin = np.where(at > 0, ends[at - 1], 0)
        length = np.where(terms[at] == items.terms, ends[at] - begin, 0)
        alive = np.flatnonzero(np.minimum.reduceat(length[flat], heads) > 0)
        listing = lambda t: positions[begin[t] : begin[t] + length[t]].astype(np.int64)
        counts = np.asarray(row["n_words"].values.to_numpy(zero_copy_only=False), dtype=np.int64)
        doc_start = np.cumsum(np.append(0, counts + 1))[:-1]
        found: dict[tuple[int, str], list] = {}
        for w in alive:
            mine = flat[heads[w] : heads[w] + sizes[w]]
            order = np.argsort(length[mine], kind="stable")
            first = listing(mine[order[0]])
            places = first - order[0]
            for k in order[1:]:
                other = listing(mine[k])
                hit = np.searchsorted(other, places + k)
                places = places[other[np.minimum(hit, len(other) - 1)] == places + k]
                if not len(places):
                    break
            for item in items.owners[w]:
                if len(places):
                    found.setdefault((item, "phrase"), []).append((places, places + sizes[w]))
            if slop is not None:
                near = first
                for t in np.unique(mine):
                    near = near[_within(near, listing(t), slop, doc_start)] if len(near) else near
                for item in items.owners[w]:
                    if len(near):
                        found.setdefault((item, "proximity"), []).append((near, near + 1))
        doc_key = row["first_key"].as_py()
        for (item, kind), parts in found.items():
            starts, stops = _runs(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
            doc = np.searchsorted(doc_start, starts, side="right") - 1
            n = len(starts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc_key + doc), pa.array([items.ids[item]] * n, pa.string()), pa.array([kind] * n), pa.array(starts - doc_start[doc]), pa.array(stops - starts)],
                names=["doc_key", "item_id", "kind", "start", "length"],
            )

    return search


def find_items(index: DataFrame, items: DataFrame, window: int = WINDOW, slop: int | None = None) -> DataFrame:
    """Where windows of ``window`` words of ``items`` (item_id, text) occur: doc_key, item_id (as string), kind, start, length.

    ``phrase``: maximal stretches of words covered by occurrences of the item's windows; an item of fewer words is one
    window. ``proximity`` (only with ``slop``): places of a window's rarest word with all its other words at most ``slop``
    words away in the same document, in any order. Items without words match nothing; equal items are found under each of their
    ids, and repeated rows of ``items`` once. More than one block of items is searched at once, not when the result is asked for.
    """
    spark = index.sparkSession
    items = items.select(F.col("item_id").cast("string").alias("item_id"), "text").filter("text IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("text") + 16).alias("b")).first().b or 0
    blocks = -(-int(size) // ITEM_BLOCK_BYTES) or 1

    def matches(block: DataFrame) -> DataFrame:
        rows = block.collect()  # about ITEM_BLOCK_BYTES
        return index.mapInArrow(_search(Items([r.item_id for r in rows], [r.text for r in rows], window), slop), MATCH)

    if blocks == 1:
        return matches(items)
    place, path = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).alias("block"), f"{work_dir(spark)}/matches-{uuid.uuid4().hex}"
    dealt = materialize(items.select("*", place))
    for i in range(blocks):
        matches(dealt.filter(F.col("block") == i).drop("block")).write.mode("append").parquet(path)
    return spark.read.schema(MATCH).parquet(path)


def covered(spans: Column) -> Column:
    """Words in the union of sorted (start, length) spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def step(a: Column, s: Column) -> Column:
        end = F.greatest(s.start + s.length, a.end)
        return F.struct((a.n + end - F.greatest(s.start, a.end)).alias("n"), end.alias("end"))

    return F.aggregate(spans, start, step)["n"]


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, item_ids (sorted strings) and contaminated for every row of ``docs``.

    Contaminated: words inside any occurrence of an item's window are at least a twentieth of all, and not none. Repeated
    rows get a result each; other columns are ignored; empty tables give no rows, or no hits.
    """
    index = build_index(docs)
    matches = find_items(index, items, window).groupBy("doc_key").agg(
        covered(F.sort_array(F.collect_list(F.struct("start", "length")))).alias("n_hit"), F.sort_array(F.collect_set("item_id")).alias("item_ids")
    )
    rows = indexed_documents(index).join(matches, "doc_key", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return rows.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def op8_positional_index(spark, sf: str) -> DataFrame:
    """All documents against all benchmark items."""
    rows = contamination(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet"))
    return rows.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"), F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


OP8_SQL = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT item_id, w, least({WINDOW}, len(w)) AS n, unnest(range(1, CAST(len(w) - least({WINDOW}, len(w)) + 2 AS BIGINT))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN pos ON d.doc_id = pos.doc_id LEFT JOIN its ON d.doc_id = its.doc_id
"""
