"""Words of many texts at once: numpy over the UTF-8 bytes of an Arrow column, no Python object per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

MASK = (1 << 64) - 1
#: The bytes that separate words: white space; everything but digits, a-z (after lower-casing) and non-ASCII.
WHITE = np.isin(np.arange(256), [32, *range(9, 14)])
NOT_ALNUM = np.array([i <= 0x2F or 0x3A <= i <= 0x60 or 0x7B <= i <= 0x7F for i in range(256)])
LOWER = np.array([i + 32 if 65 <= i <= 90 else i for i in range(256)], dtype=np.uint8)
_BASE = 0x9E3779B97F4A7C15
_LETTERS = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_CHUNK = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, base: int = _BASE) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def hash_words(data: np.ndarray, starts: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts that begin at ``starts`` (ascending) in ``data``, and each text's number of words."""
    n_texts = len(starts)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(n_texts, np.int64)
    word = ~separators[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    heads = starts[starts < len(data)]
    first[heads] = word[heads]
    begin = np.flatnonzero(first)
    counts = np.diff(np.append(np.searchsorted(begin, starts), len(begin)))
    if not len(begin):
        return np.zeros(0, np.uint64), counts
    letters = data[word]
    at = (np.cumsum(word, dtype=np.int64) - 1)[begin]
    lengths = np.diff(np.append(at, len(letters)))
    offset = np.arange(len(letters)) - np.repeat(at, lengths)
    terms = _LETTERS[letters] * _powers(int(lengths.max()))[offset]
    return mix(np.add.reduceat(terms, at)), counts


def text_words(texts: pa.Array, separators: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """As ``hash_words`` for an Arrow string array; null is empty. Works through it in pieces of bounded size."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=len(texts) + 1 + texts.offset)[texts.offset :] if len(texts) else np.zeros(1, np.int64)
    if texts.null_count:
        texts = texts.fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64, count=len(texts) + 1 + texts.offset)[texts.offset :]
    buffer = texts.buffers()[2] if len(texts) else None
    whole = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    hashes, counts, i = [], [], 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + _CHUNK, side="right")) - 1)
        data = whole[offsets[i] : offsets[j]]
        h, c = hash_words(LOWER[data] if lower else data, offsets[i:j] - offsets[i], separators)
        hashes.append(h)
        counts.append(c)
        i = j
    return np.concatenate(hashes) if hashes else np.zeros(0, np.uint64), np.concatenate(counts) if counts else np.zeros(0, np.int64)
