"""A Merkle manifest of a dataset, kept as postorder append logs.

A tree takes its leaves in order; while several nodes remain, every ``FANOUT`` consecutive ones become one. ``SEGMENT`` leaves
whose places begin at a multiple of ``SEGMENT`` are an aligned subtree, built by one task: the builder appends every node to the segment's
log when it is complete, so a node stands behind all below it. The roots of a tier's segments are the leaves of the next tier,
until a tree has one segment. A node's place in a log follows from the sizes of the subtrees before it (``postorder_position``),
so siblings are read without pointers, and a proof takes ``FANOUT`` - 1 of them a level.

Each source is a tree over its documents; the roots of the sources are the leaves of one more tree. No task holds more than a
segment: places come from ranges of the order, counted and shifted, and paths go down from the top one tier at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize

FANOUT = 16
#: Levels that one segment spans, and the leaves of a whole one.
SPAN = 3
SEGMENT = FANOUT**SPAN
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LOG = "tree string, segment long, n long, root string, nodes binary, doc_ids array<long>, changed array<binary>"
PATHS = "tree string, at long, path array<struct<before: string, after: string>>, subroot string, top string"
PROOFS = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


# --- one tree ------------------------------------------------------------------------------------


def height_of(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    height = 0
    while n > 1:
        n, height = -(-n // FANOUT), height + 1
    return height


def postorder_position(level: int, index: int, n: int, height: int) -> int:
    """Where the log of a tree of ``n`` leaves has the node ``index`` of ``level`` (0: leaves).

    Before its subtree stand whole subtrees only: those to its left at its own level, and the ancestors that they completed. Its
    own subtree ends with the node itself.
    """
    first = index * FANOUT**level
    before = sum(first // FANOUT**k for k in range(height + 1))
    leaves = min(FANOUT**level, n - first)
    return before + sum(-(-leaves // FANOUT**k) for k in range(level + 1)) - 1


def parent_of(run: list[bytes]) -> bytes:
    """The digest of a run of digests, whose hexadecimal texts are joined."""
    return sha256(b"".join(run).hex().encode()).digest()


def append_log(leaves: list[bytes], height: int) -> list[bytes]:
    """All nodes in the order of their completion; the last is the root."""
    log: list[bytes] = []
    waiting: list[list[bytes]] = [[] for _ in range(height + 1)]

    def put(level: int, node: bytes) -> None:
        log.append(node)
        if level < height:
            waiting[level].append(node)
            if len(waiting[level]) == FANOUT:
                close(level)

    def close(level: int) -> None:
        run, waiting[level] = waiting[level], []
        put(level + 1, parent_of(run))

    for leaf in leaves:
        put(0, leaf)
    for level in range(height):
        if waiting[level]:
            close(level)
    return log


def reader(nodes: bytes, n: int, height: int) -> Callable[[int, int], str]:
    """The hexadecimal digest of a node of a log, by its level and index; each is looked up once."""

    @cache
    def read(level: int, index: int) -> str:
        place = 32 * postorder_position(level, index, n, height)
        return nodes[place : place + 32].hex()

    return read


def siblings(read: Callable[[int, int], str], index: int, n: int, height: int) -> list[tuple[str, str]]:
    """Level by level, the digests before and after a leaf's ancestor in its run."""
    path = []
    for level in range(height):
        first = index - index % FANOUT
        end = min(first + FANOUT, -(-n // FANOUT**level))
        path.append(("".join(read(level, i) for i in range(first, index)), "".join(read(level, i) for i in range(index + 1, end))))
        index //= FANOUT
    return path


def fold(leaf: str, path: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings give."""
    for before, after in path:
        leaf = sha256((before + leaf + after).encode()).hexdigest()
    return leaf


# --- trees as tables -----------------------------------------------------------------------------


def _segment_height(n: int, leaves: int) -> int:
    """A tree of several segments goes up through all levels of each; the only one ends at its root."""
    return SPAN if n > SEGMENT else height_of(leaves)


def _build(key: tuple, rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("at")
    n = rows.column("n")[0].as_py()
    leaves = rows.column("digest").to_pylist()
    log = append_log(leaves, _segment_height(n, len(leaves)))
    schema = pa.schema(
        [("tree", pa.string()), ("segment", pa.int64()), ("n", pa.int64()), ("root", pa.string()), ("nodes", pa.binary()),
         ("doc_ids", pa.list_(pa.int64())), ("changed", pa.list_(pa.binary()))]
    )
    row = [key[0].as_py(), key[1].as_py(), n, log[-1].hex(), b"".join(log), rows.column("doc_id").to_pylist(), rows.column("changed").to_pylist()]
    return pa.table([[x] for x in row], schema=schema)


def _placed(leaves: DataFrame, order: list[str]) -> DataFrame:
    """``leaves`` (tree, ...) with ``at``, their place in their tree, and ``n``, the leaves of it.

    Ranges of the order are numbered; a place is the number in the range plus the sizes of the tree's ranges before. So a
    tree may have any share of the leaves.
    """
    dealt = materialize(leaves.repartitionByRange("tree", *order).withColumn("part", F.spark_partition_id()))
    sizes = dealt.groupBy("tree", "part").agg(F.count("*").alias("n_part"))
    of_tree = Window.partitionBy("tree")
    shifts = sizes.select(
        "tree", "part", F.sum("n_part").over(of_tree).alias("n"),
        F.coalesce(F.sum("n_part").over(of_tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("shift"),
    )
    number = F.row_number().over(Window.partitionBy("tree", "part").orderBy(*order)) - 1
    return dealt.withColumn("number", number).join(shifts, ["tree", "part"]).withColumn("at", F.col("number") + F.col("shift"))


def _tiers(placed: DataFrame) -> list[DataFrame]:
    """The logs of all trees, lowest tier first; each is a written table with a row per segment."""
    level, tiers = placed.select("tree", "at", "n", "digest", "doc_id", "changed"), []
    while True:
        by_segment = level.withColumn("segment", F.floor(F.col("at") / SEGMENT).cast("long"))
        tiers.append(materialize(by_segment.groupBy("tree", "segment").applyInArrow(_build, LOG)))
        wide = tiers[-1].filter(F.col("n") > SEGMENT)
        if wide.isEmpty():
            return tiers
        level = wide.select(
            "tree", F.col("segment").alias("at"), F.ceil(F.col("n") / SEGMENT).cast("long").alias("n"), F.unhex("root").alias("digest"),
            F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("changed"),
        )


def _roots(tiers: list[DataFrame]) -> DataFrame:
    """tree, root: a tree's root is that of its only segment of the last tier that it has."""
    whole = [t.filter(F.col("n") <= SEGMENT).select("tree", "root") for t in tiers]
    out = whole[0]
    for t in whole[1:]:
        out = out.unionByName(t)
    return out


def _leaves(row: dict) -> Iterator[tuple[int, str, list[tuple[str, str]]]]:
    """The leaves of a segment, each with its digest and its siblings in the segment and above it."""
    leaves = min(SEGMENT, row["n"] - row["segment"] * SEGMENT)
    height = _segment_height(row["n"], leaves)
    read = reader(row["nodes"], leaves, height)
    above = [(p["before"], p["after"]) for p in row["path"]]
    for i in range(leaves):
        yield i, read(0, i), siblings(read, i, leaves, height) + above


def _down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From a tier's segments and their paths to the paths of the segments below."""
    schema = pa.schema(
        [("tree", pa.string()), ("at", pa.int64()), ("path", pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))),
         ("subroot", pa.string()), ("top", pa.string())]
    )
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            found = [(row["segment"] * SEGMENT + at, [{"before": b, "after": a} for b, a in path]) for at, _, path in _leaves(row)]
            for k in range(0, len(found), 512):
                some = found[k : k + 512]
                columns = [[row["tree"]] * len(some), [at for at, _ in some], [path for _, path in some], [row["subroot"]] * len(some), [row["top"]] * len(some)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([(n, t) for n, t in zip(PROOFS.replace(",", "").split()[::2], [pa.int64(), *[pa.string()] * 5, pa.bool_()])])
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            out = []
            for at, leaf, path in _leaves(row):
                changed = row["changed"][at]
                proof = sha256("".join(b + a for b, a in path).encode()).hexdigest()
                folded = fold(changed.hex() if changed is not None else leaf, path)
                out.append((row["doc_ids"][at], leaf, row["subroot"], row["top"], proof, folded, folded == row["top"]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)


def _paths_to_leaves(tiers: list[DataFrame], ends: DataFrame) -> DataFrame:
    """The lowest tier's segments with path, subroot and top. ``ends`` (tree, path, subroot, top): what stands above each tree's root."""
    above = None
    for tier in reversed(tiers):
        placed = tier.filter(F.col("n") <= SEGMENT).join(ends, "tree")
        if above is not None:
            placed = placed.unionByName(tier.filter(F.col("n") > SEGMENT).join(above, ["tree", "segment"]))
        if tier is tiers[0]:
            return placed
        above = materialize(_leaf_paths(placed)).withColumnRenamed("at", "segment")
    raise ValueError("a tree has one tier at least")


def _leaf_paths(placed: DataFrame) -> DataFrame:
    """``PATHS`` of the leaves of segments that have theirs."""
    return placed.select("tree", "segment", "n", "nodes", "path", "subroot", "top").mapInArrow(_down, PATHS)


# --- documents -----------------------------------------------------------------------------------


def _told(column: Column) -> Column:
    """A value with its length, so that no two rows have the same text; null is a dash."""
    text = column.cast("string")
    return F.when(column.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def document_digest(text: Column) -> Column:
    """The hexadecimal leaf of a row of documents with the given text."""
    return F.sha2(F.concat(*(_told(c) for c in (F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text))), 256)


@dataclass(frozen=True)
class Manifest:
    """The logs of the sources, lowest tier first, those of the tree over their roots, and its leaves (at, name, digest)."""

    sources: list[DataFrame]
    top: list[DataFrame]
    subroots: DataFrame

    def proofs(self) -> DataFrame:
        """``PROOFS`` for every document, its siblings read from the logs; a changed document is folded with its changed leaf."""
        none = F.array().cast("array<struct<before: string, after: string>>")
        root = _roots(self.top).select("tree", none.alias("path"), F.col("root").alias("subroot"), F.col("root").alias("top"))
        by_source = _leaf_paths(_paths_to_leaves(self.top, root)).select("at", "path", "top")
        names = self.subroots.select("at", F.col("name").alias("tree"), F.lower(F.hex("digest")).alias("subroot"))
        ends = materialize(names.join(by_source, "at").drop("at"))
        return _paths_to_leaves(self.sources, ends).mapInArrow(_proofs, PROOFS)


def build_manifest(docs: DataFrame, changed: Column | None = None) -> Manifest:
    """The manifest of ``docs`` (doc_id long, text, lang, source, n_chars); ``changed``: a text that a reader found instead, or null.

    Leaves ascend by doc_id, null first, those of equal doc_id by their digests, so repeated rows are leaves of their own. A null
    source is a source of its own, before all others. Null and empty values have different digests; other columns are ignored; an empty table
    gives a manifest without any root. Digests are taken where documents are scanned: texts do not move.
    """
    # a null source is the empty name, others begin with a sign: names sort as the sources do
    name = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    given = F.lit(None).cast("string") if changed is None else changed
    other = F.when(given.isNotNull(), F.unhex(document_digest(given)))
    leaves = materialize(
        docs.select(
            name.alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), F.unhex(document_digest(F.col("text"))).alias("digest"),
            other.alias("changed"), F.monotonically_increasing_id().alias("row"),
        )
    )
    # the number of the row keeps very many equal rows from being one place of the order
    sources = _tiers(_placed(leaves, ["doc_id", "digest", "row"]))
    roots = _roots(sources).select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.unhex("root").alias("digest"))
    subroots = materialize(_placed(roots, ["name"]))
    top = _tiers(subroots.select("*", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("changed")))
    return Manifest(sources, top, subroots)


def op13_merkle_manifest(spark, sf: str) -> DataFrame:
    """All documents with their proofs; where 5 divides the checksum of a doc_id, its text has lost its capitals."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    tampered = F.when(checksum % 5 == 0, F.translate("text", UPPER, LOWER))
    # a null text stays null, which is what was there
    return build_manifest(docs, tampered).proofs()


_CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda ch: [ascii(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))"""


def _sql_told(column: str) -> str:
    return f"coalesce(octet_length(encode({column}::VARCHAR))::VARCHAR || ':' || {column}::VARCHAR, '-')"


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(_sql_told(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_TAMPERED = f"CASE WHEN ({_CRC}) % 5 = 0 THEN translate(text, '{UPPER}', '{LOWER}') ELSE text END"
OP13_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place FROM (
    SELECT doc_id, coalesce('=' || source, '') AS tree, {_sql_leaf('text')} AS leaf, {_sql_leaf(_TAMPERED)} AS other FROM documents)),
nodes AS (
  SELECT tree, 0 AS level, place AS idx, leaf AS h, count(*) OVER (PARTITION BY tree) AS n FROM leaves
  UNION ALL
  SELECT tree, level + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), (n + 15) // 16 FROM nodes WHERE n > 1 GROUP BY tree, level, idx // 16, n),
subroots AS (SELECT tree, h AS subroot, level AS steps, row_number() OVER (ORDER BY tree) - 1 AS place FROM nodes WHERE n = 1),
top AS (
  SELECT 0 AS level, place AS idx, subroot AS h, count(*) OVER () AS n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 16, sha256(string_agg(h, '' ORDER BY idx)), (n + 15) // 16 FROM top WHERE n > 1 GROUP BY level, idx // 16, n),
steps AS (
  SELECT s.tree, s.place, x.level AS step, coalesce(string_agg(y.h, '' ORDER BY y.idx) FILTER (y.idx < x.idx), '') AS before,
    coalesce(string_agg(y.h, '' ORDER BY y.idx) FILTER (y.idx > x.idx), '') AS after
  FROM leaves s JOIN nodes x ON x.tree = s.tree AND x.idx = s.place // (16 ** x.level)::BIGINT AND x.n > 1
    JOIN nodes y ON y.tree = x.tree AND y.level = x.level AND y.idx // 16 = x.idx // 16
  GROUP BY s.tree, s.place, x.level
  UNION ALL
  SELECT l.tree, l.place, s.steps + x.level, coalesce(string_agg(y.h, '' ORDER BY y.idx) FILTER (y.idx < x.idx), ''),
    coalesce(string_agg(y.h, '' ORDER BY y.idx) FILTER (y.idx > x.idx), '')
  FROM leaves l JOIN subroots s USING (tree) JOIN top x ON x.idx = s.place // (16 ** x.level)::BIGINT AND x.n > 1
    JOIN top y ON y.level = x.level AND y.idx // 16 = x.idx // 16
  GROUP BY l.tree, l.place, s.steps + x.level),
proofs AS (
  SELECT l.tree, l.place, sha256(coalesce(string_agg(before || after, '' ORDER BY step), '')) AS proof_sha256, count(step) AS n_steps
  FROM leaves l LEFT JOIN steps USING (tree, place) GROUP BY l.tree, l.place),
folded AS (
  SELECT tree, place, 0 AS step, other AS h FROM leaves
  UNION ALL
  SELECT f.tree, f.place, f.step + 1, sha256(before || h || after) FROM folded f JOIN steps s ON s.tree = f.tree AND s.place = f.place AND s.step = f.step)
SELECT doc_id, leaf, subroot, root, proof_sha256, f.h AS folded_root, f.h = root AS verified
FROM leaves JOIN subroots USING (tree) JOIN proofs p ON p.tree = leaves.tree AND p.place = leaves.place
  JOIN folded f ON f.tree = leaves.tree AND f.place = leaves.place AND f.step = p.n_steps, (SELECT h AS root FROM top WHERE n = 1)
"""
