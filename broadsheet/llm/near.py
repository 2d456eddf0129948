"""Near duplicates by order MinHash, verified by banded alignment.

A text is the sequence of its five-word shingles, each labelled with how often it occurred before. For each of ``SKETCHES``
seeds, the ``SAMPLED`` labelled shingles with the smallest hashes are taken in text order; their hash is a key. Texts that
agree in most shingles *and* their order share keys. In each bucket of equal keys the texts are compared with ``PIVOTS`` pivots, the
most central ones first, so the pairs grow with the texts, not with the squares of the buckets; while rounds find links and buckets
still hold several components, further rounds take other pivots, ``ROUNDS`` at most. What buckets then still hold apart is settled exactly: their
texts meet by a prefix filter over all their shingles, and every pair it leaves is compared. So do all short texts, for which
sketches are too coarse. Similarity is ``m / (n1 + n2 - m)`` with the m shingles that an alignment of both sequences matches: Jaccard
similarity that also asks for the order. The alignment is banded: beyond the band no alignment can reach the threshold.

Equal texts are one node: only one of them is compared. Links are joined to classes by star contraction over tables in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from .words import WHITE, mix, text_words

SHINGLE = 5
SIMILARITY = 0.8
#: With 5 sampled of 32, a long pair at similarity 0.8 shares no key with a probability of about 3e-6, the shortest above ``SHORT`` 2e-5.
SKETCHES = 32
SAMPLED = 5
#: Pairs with a text of at most so many shingles are found exactly.
SHORT = 20
PIVOTS = 4
#: Rounds of pivots at most; what they leave apart is settled exactly.
ROUNDS = 6
#: Each class of sizes is so much wider than the one before.
SIZE_STEP = 1.05
_SEEDS = np.random.default_rng(7).integers(1, 2**63, (2, SKETCHES), dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_NOTHING = mix(np.array([12345], np.uint64))


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of all ``SHINGLE`` neighbouring words; a shorter text is one shingle, also if it has no words."""
    if not len(words):
        return _NOTHING
    size = min(SHINGLE, len(words))
    out = np.zeros(len(words) - size + 1, np.uint64)
    for k in range(size):
        out = mix(out * _STEP + words[k : k + len(out)])
    return out


def _occurrence(values: np.ndarray) -> np.ndarray:
    """How often each value occurred before its place."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    head = np.append(True, ordered[1:] != ordered[:-1])
    if head.all():
        return np.zeros(len(values), np.uint64)
    first = np.flatnonzero(head)
    rank = np.arange(len(values)) - np.repeat(first, np.diff(np.append(first, len(values))))
    out = np.empty(len(values), np.uint64)
    out[order] = rank
    return out


def sketch(sequence: np.ndarray) -> np.ndarray:
    """The keys of a shingle sequence, one per seed."""
    labelled = mix(sequence + _occurrence(sequence) * _STEP)
    keys, step = [], max(1, (1 << 21) // len(sequence))
    for i in range(0, SKETCHES, step):
        flip, odd = _SEEDS[0, i : i + step, None], _SEEDS[1, i : i + step, None] | np.uint64(1)
        value = (labelled ^ flip) * odd
        value ^= value >> np.uint64(29)
        value *= _STEP
        taken = min(SAMPLED, len(sequence))
        places = np.argpartition(value, taken - 1, axis=1)[:, :taken] if taken < len(sequence) else np.tile(np.arange(taken), (len(value), 1))
        picked = sequence[np.sort(places, axis=1)]
        key = flip[:, 0].copy()
        for k in range(taken):
            key = mix(key * _STEP + picked[:, k])
        keys.append(key)
    return np.concatenate(keys)


def _word_lists(texts: pa.Array) -> Iterator[np.ndarray]:
    words, counts = text_words(texts, WHITE)
    ends = np.cumsum(counts)
    for end, n in zip(ends, counts):
        yield words[end - n : end]


def _pieces(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in _pieces(whole):
            sequences = [shingles(w) for w in _word_lists(batch.column("text"))]
            keys = np.concatenate([sketch(s) for s in sequences]).view(np.int64)
            lists = pa.ListArray.from_arrays(np.arange(0, len(keys) + 1, SKETCHES, dtype=np.int32), keys)
            sizes = pa.array([len(s) for s in sequences], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), sizes, lists], names=["doc_id", "digest", "size", "keys"])


def _stored_sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in _pieces(whole):
            # half of each word's hash: five of them in a row make a shingle
            out = [(w >> np.uint64(32)).astype(np.uint32).tobytes() for w in _word_lists(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(out, pa.binary())], names=["node", "sequence"])


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, root, size, at, token: a row for each labelled shingle, with its place in the text."""
    for whole in batches:
        for batch in _pieces(whole, 32):
            sequences = [shingles(np.frombuffer(x.as_buffer(), np.uint32).astype(np.uint64)) for x in batch.column("sequence")]
            sizes = np.array([len(s) for s in sequences], np.int32)
            tokens = np.concatenate([mix(s + _occurrence(s) * _STEP) for s in sequences]).view(np.int64)
            each = lambda c: np.repeat(batch.column(c).to_numpy(), sizes)
            at = np.concatenate([np.arange(n, dtype=np.int32) for n in sizes])
            columns = {"node": each("node"), "root": each("root"), "size": np.repeat(sizes, sizes), "at": at, "token": tokens}
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns.values()], names=list(columns))


def _matched_bound(a: np.ndarray, b: np.ndarray) -> int:
    """Shingles that both sequences have, in any order, with repeats: no alignment matches more."""
    va, ca = np.unique(a, return_counts=True)
    vb, cb = np.unique(b, return_counts=True)
    _, ia, ib = np.intersect1d(va, vb, assume_unique=True, return_indices=True)
    return int(np.minimum(ca[ia], cb[ib]).sum())


def banded_matches(a: list[int], b: list[int], band: int) -> int:
    """The most values that an alignment of ``a`` and ``b`` within ``band`` of the diagonal matches.

    One bit per column of the band; a 0 is a step of the alignment's score.
    """
    width = 2 * band + 1
    full = (1 << width) - 1
    places: dict[int, list[int]] = {}
    for j, y in enumerate(b):
        places.setdefault(y, []).append(j)
    masks = {y: sum(1 << j for j in js) for y, js in places.items() if len(js) > 16}
    row, score = full, 0
    for i, x in enumerate(a):
        base, hit = i - band, 0
        if x in masks:
            hit = (masks[x] >> base if base >= 0 else masks[x] << -base) & full
        else:
            for j in places.get(x, ()):
                if 0 <= j - base < width:
                    hit |= 1 << (j - base)
        both = row & hit
        row = ((row + both) | (row - both)) & full
        score += not row & 1
        row = row >> 1 | 1 << (width - 1)
    return score + width - row.bit_count()


def similarity(a: np.ndarray, b: np.ndarray, threshold: float = SIMILARITY) -> float:
    """Similarity of two shingle sequences, or 0 where it is below ``threshold``."""
    total = len(a) + len(b)
    least = threshold * total / (1 + threshold)
    if min(len(a), len(b)) < least - 1e-9 or _matched_bound(a, b) < least - 1e-9:
        return 0.0
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    differ = np.flatnonzero(a[::-1][: short - head] != b[::-1][: short - head])
    tail = int(differ[0]) if len(differ) else short - head
    left, right = a[head : len(a) - tail], b[head : len(b) - tail]
    matched = head + tail
    if len(left) and len(right):
        matched += banded_matches(left.tolist(), right.tolist(), int(total - 2 * least) + 1)
    found = matched / (total - matched)
    return found if found >= threshold - 1e-12 else 0.0


def _verify(threshold: float):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            read = lambda c: (shingles(np.frombuffer(x.as_buffer(), np.uint32).astype(np.uint64)) for x in batch.column(c))
            linked = [similarity(a, b, threshold) > 0 for a, b in zip(read("sequence"), read("pivot_sequence"))]
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("pivot")], names=["node", "pivot"]).filter(pa.array(linked, pa.bool_()))

    return verify


def _written(df: DataFrame) -> tuple[DataFrame, dict]:
    """The written table, with its rows (n) and a sum of hashes (s) that tells whether two tables are equal."""
    seen = Observation()
    columns = [F.col(c) for c in df.columns]
    table = materialize(df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias("s")))
    return table, seen.get


def _pairs(members: DataFrame, round_no: int, threshold: float) -> DataFrame:
    """node, pivot: the members (key, node, size, root, central) of every bucket with its ``PIVOTS`` pivots, across components.

    Sizes too different for the threshold make no pair.

    A hash of node and key cuts a bucket into classes; the most central member of each, then the one with the largest hash, is
    a pivot. So a bucket gives as many pairs as it has members times the number of pivots, and each maximum combines map-side.
    """
    kind = F.pmod(F.xxhash64(F.lit(round_no), "key", "node"), F.lit(PIVOTS))
    best = F.struct("central", F.xxhash64(F.lit(round_no), "node").alias("h"), "node", "size", "root")
    pivots = members.groupBy("key").agg(
        F.array_compact(F.array(*(F.max(F.when(kind == i, best)) for i in range(PIVOTS)))).alias("pivots"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    met = members.join(pivots.filter("low <> high"), "key").select("node", "size", "root", F.explode("pivots").alias("p")).filter("root <> p.root")
    met = met.filter(F.least("size", "p.size") >= threshold * F.greatest("size", "p.size") - 1e-9)
    return met.select(F.greatest("node", "p.node").alias("node"), F.least("node", "p.node").alias("pivot")).distinct()


def _exact_pairs(members: DataFrame, sequences: DataFrame, threshold: float) -> DataFrame:
    """node, pivot: pairs across components of ``members`` (node, root), among them all that reach the threshold.

    A text stays if other components have enough of its shingles at all. Then a prefix filter: if the shingles of all texts have one
    order, the first shingle that an alignment of two similar texts matches is among the first few of both. The order puts
    those first that only one component has, which make no pair, then rare ones. How few depends on both sizes, and the places of a match
    in both texts differ by no more than what the alignment may leave out; so texts meet by shingle, by classes of both sizes and by stretches of
    the text, each only where its own shingle stands early enough for the other's class. Texts that share a passage but too little else do not meet.
    """
    read = members.join(sequences, "node").select("node", "root", "sequence")
    tokens = materialize(read.mapInArrow(_labelled, "node long, root long, size int, at int, token long"))
    own = Window.partitionBy("node")

    def across(table: DataFrame) -> DataFrame:
        ends = table.groupBy("token").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
        return materialize(ends.filter("low <> high").select("token", "n"))

    def covered(table: DataFrame) -> DataFrame:
        shared = table.join(across(table), "token").withColumn("common", F.count("*").over(own))
        return shared.filter(F.col("common") >= threshold * F.col("size") - 1e-9)

    kept = materialize(covered(tokens).select(*tokens.columns))
    place = F.col("size") - F.col("common") + F.row_number().over(own.orderBy("n", "token")) - 1
    first = F.col("place") <= F.col("size") - F.ceil(threshold * F.col("size") - 1e-9)
    prefixes = materialize(covered(kept).withColumn("place", place).filter(first).select(*tokens.columns, "place"))
    prefixes = materialize(prefixes.join(across(prefixes), "token").select(*prefixes.columns))

    # of two sizes, an alignment has to match so many shingles
    share = threshold / (1 + threshold)
    kind = lambda size: F.floor(F.log(size) / log(SIZE_STEP) + 1e-9).cast("int")
    lowest = lambda c: F.pow(F.lit(SIZE_STEP), F.col(c)) - 1e-6
    size, early = F.col("size"), F.col("size") - F.col("place") + 1e-9
    # what the alignment of a text of at least the lower class with one of at most the upper class may leave out
    longest = F.pow(F.lit(SIZE_STEP), F.col("upper") + 1) + 1e-6
    width = F.ceil(longest - share * (lowest("lower") + longest)) + 1
    stretch = F.floor(F.col("at") / width).cast("long")
    shorter = prefixes.withColumns({"lower": kind(size), "upper": F.explode(F.sequence(kind(size), kind(size / threshold + 1e-6)))})
    shorter = shorter.filter(early >= share * (size + F.greatest(size, lowest("upper")))).withColumn("stretch", stretch)
    longer = prefixes.withColumns({"upper": kind(size), "lower": F.explode(F.sequence(kind(F.greatest(threshold * size - 1e-6, F.lit(1.0))), kind(size)))})
    longer = longer.filter(early >= share * (size + F.greatest(threshold * size, lowest("lower"))))
    longer = longer.withColumn("stretch", F.explode(F.array(stretch - 1, stretch, stretch + 1)))
    longer = longer.select("token", "lower", "upper", "stretch", *(F.col(c).alias(f"p_{c}") for c in ("node", "root", "size", "at", "place")))
    # components meet before their texts do, so texts that are already together make no rows
    key, p_root = ["token", "lower", "upper", "stretch"], "p_root"
    spare = lambda p: F.max((1 - share) * F.col(f"{p}size") - F.col(f"{p}place")) + 1e-9
    groups = shorter.groupBy(*key, "root").agg(F.min("size").alias("least"), spare("").alias("spare"))
    p_groups = longer.groupBy(*key, p_root).agg(F.min("p_size").alias("p_least"), spare("p_").alias("p_spare"))
    apart = (F.col("root") != F.col(p_root)) & (F.col("spare") >= share * F.col("p_least")) & (F.col("p_spare") >= share * F.col("least"))
    roots = materialize(groups.join(p_groups, key).filter(apart).select(*key, "root", p_root))
    met = roots.join(shorter, [*key, "root"]).join(longer, [*key, p_root]).filter("size < p_size OR size = p_size AND node < p_node")
    least = share * (F.col("size") + F.col("p_size")) - 1e-9
    # no more than what follows the first common shingle can match, nor further apart than what is left out
    met = met.filter(F.least(F.col("size") - F.col("place"), F.col("p_size") - F.col("p_place")) >= least)
    met = met.filter(F.abs(F.col("at") - F.col("p_at")) <= F.col("p_size") - least)
    return met.select(F.greatest("node", "p_node").alias("node"), F.least("node", "p_node").alias("pivot")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of ``links`` (a long, b long): root is the smallest node of the component.

    Alternates large-star and small-star steps until the links no longer change; every step is written.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # written, so that the join with it can be split where a node has very many links
        least = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        edges = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(edges.filter("a <> b").distinct())
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges, now = _written(moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        if now == state:
            break
        state = now
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return materialize(roots.unionByName(roots.select(F.col("root").alias("node"), "root")).distinct())


def text_digest(text: Column | str = "text") -> Column:
    """What tells texts apart; a null text is the empty one."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def near_duplicate_classes(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """doc_id and class_id for every row of ``docs`` (doc_id long, text): near duplicates share the smallest doc_id of all.

    Null texts are empty; texts without words are copies of each other. Repeated rows get a result each; a row without
    doc_id gets the class of its copies, or none. Other columns are ignored; an empty table gives an empty one.
    """
    by_text, rows = _classes(docs, threshold)
    named = by_text.groupBy("root").agg(F.min("least").alias("class_id"))
    by_digest = by_text.join(named, "root").select("digest", "class_id")
    return rows.join(by_digest, "digest").select("doc_id", "class_id")


def one_of_each_class(docs: DataFrame, threshold: float = SIMILARITY) -> DataFrame:
    """``docs`` (doc_id long, text, any other columns) with one row of each class of near duplicates.

    That of the smallest doc_id; where no row of the class has one, any of its texts that is always the same. Of repeated rows one stays.
    """
    by_text, _ = _classes(docs, threshold)
    first = F.min(F.struct(F.col("least").isNull().alias("none"), "least", "digest")).alias("first")
    kept = by_text.groupBy("root").agg(first).select(*(F.col(f"first.{c}").alias(f"k_{c}") for c in ("digest", "least", "none")))
    # the same three keys for the join and for dropping repeated rows: documents move once
    keys = {"_digest": text_digest(), "_least": F.coalesce("doc_id", F.lit(0)), "_none": F.col("doc_id").isNull()}
    kept = kept.select(F.col("k_digest").alias("_digest"), F.coalesce("k_least", F.lit(0)).alias("_least"), F.col("k_none").alias("_none"))
    return docs.withColumns(keys).join(kept, list(keys), "left_semi").dropDuplicates(list(keys)).drop(*keys)


def _classes(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """digest, least, root for every text, root being the same in a class, and doc_id, digest for every row."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), text_digest().alias("digest"))
    sketched = materialize(rows.mapInArrow(_sketches, "doc_id long, digest binary, size int, keys array<long>"))
    # one node per text, numbered once and for all
    texts = sketched.groupBy("digest").agg(F.min("doc_id").alias("least"), F.min("size").alias("size"), F.min_by("keys", F.coalesce("doc_id", F.lit(2**63 - 1)).cast("long")).alias("keys"))
    nodes = materialize(texts.select("digest", "least", "size", "keys", F.monotonically_increasing_id().alias("node")))

    keyed = nodes.select("node", "size", F.explode("keys").alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = materialize(keyed.join(sizes, "key").select("key", "node", "size", "n"))
    # the text in the middle of a group of copies shares the most keys
    central = shared.groupBy("node").agg(F.sum("n").alias("central"))
    shared = materialize(shared.select("key", "node", "size").join(central, "node"))
    pairs = materialize(_pairs(shared.select("key", "node", "size", F.col("node").alias("root"), "central"), 0, threshold))
    # one row of each text; equal rows are next to each other after the join, so dropping them moves nothing
    none = F.lit(-(2**63)).cast("long")
    short = nodes.filter(F.col("size") <= int(SHORT / threshold + 1e-9)).select("node")
    chosen = nodes.join(shared.select("node").unionByName(short).distinct(), "node").select("node", "digest", F.coalesce("least", none).alias("id"))
    found = rows.select("digest", F.coalesce("doc_id", none).alias("id"), "text").join(chosen, ["digest", "id"]).dropDuplicates(["digest", "id"])
    sequences = materialize(found.select("node", "text").mapInArrow(_stored_sequences, "node long, sequence binary"))
    pivots = sequences.select(F.col("node").alias("pivot"), F.col("sequence").alias("pivot_sequence"))

    def links(pairs: DataFrame) -> tuple[DataFrame, dict]:
        compared = pairs.join(sequences, "node").join(pivots, "pivot").select("node", "pivot", "sequence", "pivot_sequence")
        return _written(compared.mapInArrow(_verify(threshold), "node long, pivot long").select(F.col("node").alias("a"), F.col("pivot").alias("b")))

    def joined(linked: DataFrame) -> DataFrame:
        return components(linked if roots is None else linked.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))

    roots, round_no, tested = None, 0, pairs
    while True:
        linked, stats = links(pairs)
        if not stats["n"] and roots is not None:
            break
        roots = joined(linked)
        # buckets that still hold several components: other pivots
        round_no += 1
        if round_no == ROUNDS:
            break
        placed = shared.join(roots, "node", "left").select("key", "node", "size", F.coalesce("root", "node").alias("root"), F.lit(0).cast("long").alias("central"))
        pairs, stats = _written(_pairs(placed, round_no, threshold).join(tested, ["node", "pivot"], "left_anti"))
        if not stats["n"]:
            break
        tested = tested.unionByName(pairs)

    # what the pivots left apart; in a bucket of two they were compared
    placed = materialize(shared.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root")))
    apart = placed.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).filter("n > 2 AND low <> high")
    members = placed.join(apart.select("key"), "key").select("node", "root")
    members = members.unionByName(short.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root")))
    members, stats = _written(members.distinct())
    if stats["n"]:
        pairs, stats = _written(_exact_pairs(members, sequences, threshold).join(tested, ["node", "pivot"], "left_anti"))
        if stats["n"]:
            linked, stats = links(pairs)
            roots = joined(linked) if stats["n"] else roots

    classes = nodes.join(roots, "node", "left").select("digest", "least", F.coalesce("root", "node").alias("root"))
    return classes, sketched.select("doc_id", "digest")


def op2_order_minhash(spark, sf: str) -> DataFrame:
    """All documents with their near-duplicate class."""
    return near_duplicate_classes(spark.read.parquet(f"{sf}/documents.parquet"))
