"""Token ids packed into rows of a fixed length, best fit decreasing.

A map over the input: every task encodes its texts and packs them in blocks of about ``BLOCK_TOKENS`` tokens, so no token is
shuffled and memory is bounded. A document ends with the end id. Documents longer than a row are cut into whole rows and a
rest, losslessly. In a block the rests go, longest first, into the open row with the least free space that holds them; a
segment tree over the free spaces 0 to ``length`` finds that row in logarithmic time.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame

#: Byte-level ranks, one "token rank" per line; the file has to be in the same place on all machines.
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How a byte-level vocabulary of this kind cuts a text before merging (a fixed value of the vocabulary).
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END_ID = 50256
LENGTH = 2048
BLOCK_TOKENS = 1 << 20
PACKED = "block long, row int, input_ids binary, position_ids binary, cu_seqlens array<int>, doc_ids array<long>, doc_keys array<long>, starts array<long>, n_tokens int"


@lru_cache(maxsize=2)
def _encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoder(path: str = RANKS) -> Callable[[str], np.ndarray]:
    """Text to ids; control strings in a text are ordinary text."""
    encode = _encoding(path).encode_ordinary
    return lambda text: np.frombuffer(array("H", encode(text)), dtype=np.uint16)


class FreeSpace:
    """How many open rows have each free space; a segment tree finds the least space that suffices."""

    def __init__(self, length: int):
        self.size = 1 << length.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: dict[int, list[int]] = {}

    def _add(self, space: int, n: int) -> None:
        at = self.size + space
        while at:
            self.count[at] += n
            at >>= 1

    def put(self, space: int, row: int) -> None:
        self.rows.setdefault(space, []).append(row)
        self._add(space, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(space, row) of an open row with the least space of at least ``need``."""
        at = self.size + need
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at ^ 1]):
                at >>= 1
            if at <= 1:
                return None
            at ^= 1
            while at < self.size:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        space = at - self.size
        row = self.rows[space].pop()
        self._add(space, -1)
        return space, row


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Rows of indices into ``sizes`` (each at most ``length``), longest first, equal ones in their order."""
    free, rows = FreeSpace(length), []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = free.take(sizes[i])
        if found is None:
            rows.append([])
            found = (length, len(rows) - 1)
        rows[found[1]].append(i)
        free.put(found[0] - sizes[i], found[1])
    return rows


def _pack(path: str, length: int, block_tokens: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = encoder(path)
        base = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        held, tokens, key, block = [], 0, base, base
        for batch in batches:
            places = batch.column("place").to_pylist() if "place" in batch.schema.names else [None] * batch.num_rows
            for doc_id, text, place in zip(batch.column("doc_id"), batch.column("text"), places):
                if place is not None and place != key:
                    # another stretch of the order begins
                    if held:
                        yield from flush(held, block)
                    held, tokens, key, block = [], 0, place, place
                held.append((doc_id.as_py(), key, np.append(ids(text.as_py() or ""), np.uint16(END_ID))))
                tokens += len(held[-1][2])
                key += 1
                if tokens >= block_tokens:
                    yield from flush(held, block)
                    held, tokens, block = [], 0, block + 1 if place is None else key
        if held:
            yield from flush(held, block)

    def flush(held: list, block: int) -> Iterator[pa.RecordBatch]:
        pieces = [(d, k, start, ids[start : start + length]) for d, k, ids in held for start in range(0, len(ids), length)]
        rows = best_fit_decreasing([len(p[3]) for p in pieces], length)
        for i in range(0, len(rows), 512):
            yield matrix([[pieces[p] for p in row] for row in rows[i : i + 512]], block, i)

    def matrix(rows: list, block: int, first: int) -> pa.RecordBatch:
        ids = np.full((len(rows), length), END_ID, np.uint16)
        positions = np.zeros((len(rows), length), np.uint16 if length <= 1 << 16 else np.uint32)
        ends = []
        for i, row in enumerate(rows):
            ends.append([0])
            for piece in row:
                at = ends[-1][-1]
                ids[i, at : at + len(piece[3])] = piece[3]
                positions[i, at : at + len(piece[3])] = np.arange(len(piece[3]))
                ends[-1].append(at + len(piece[3]))
        column = lambda k: pa.array([[p[k] for p in row] for row in rows], pa.list_(pa.int64()))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([block] * len(rows), pa.int64()), pa.array(range(first, first + len(rows)), pa.int32()),
                pa.array([r.tobytes() for r in ids], pa.binary()), pa.array([r.tobytes() for r in positions], pa.binary()),
                pa.array(ends, pa.list_(pa.int32())), column(0), column(1), column(2), pa.array([e[-1] for e in ends], pa.int32()),
            ],
            names=["block", "row", "input_ids", "position_ids", "cu_seqlens", "doc_ids", "doc_keys", "starts", "n_tokens"],
        )

    return pack


def pack_tokens(docs: DataFrame, length: int = LENGTH, ranks: str = RANKS, block_tokens: int = BLOCK_TOKENS, place: Column | None = None) -> DataFrame:
    """The packed id matrix of ``docs`` (doc_id long, text), one row per matrix row.

    input_ids: ``length`` little-endian 16-bit ids, filled up with the end id; position_ids: places that start again at 0
    with every piece; cu_seqlens: where the pieces begin, and the end of the last; doc_ids, doc_keys (one per input row) and
    starts (the piece's first token in its document), one each per piece; n_tokens: without filling. A null or empty text is
    the end id alone. Repeated rows are packed again, each under its own key; other columns are ignored; an empty table gives no rows.

    ``place`` (long, not null) numbers the rows in an order that the input has within its tasks: a block then holds a stretch of consecutive places,
    and is named by the first, so that blocks follow each other as the rows do.
    """
    columns = ["doc_id", "text"] if place is None else ["doc_id", "text", place.alias("place")]
    return docs.select(*columns).mapInArrow(_pack(ranks, length, block_tokens), PACKED)


def write_packed(packed: DataFrame, path: str) -> None:
    """The matrix as Parquet files: binary rows of one fixed size."""
    packed.write.parquet(path)


def op9_packed_tokens(spark, sf: str) -> DataFrame:
    """All documents, packed."""
    return pack_tokens(spark.read.parquet(f"{sf}/documents.parquet"))
