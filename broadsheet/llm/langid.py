"""Language identification by interpolated Kneser-Ney models of characters.

A text is lower-cased; whatever is no letter or mark is white space, and each stretch of it one space. For every language all windows of
``ORDER`` UTF-16 units are counted over all its documents, on Spark. The top order keeps these counts; a lower one counts in how many
different windows one unit longer a window ends (its continuations). Discounts come from the windows seen once and twice. A model
is, per order, a sorted array of window hashes with counts, and one of context hashes with totals and followers; probabilities are looked
up by binary search and interpolated from no context upwards. Hashes have so many bits that all arrays together have ``SLOTS`` entries at most, however
many windows the corpus has: that bounds what is broadcast. Windows that fall together add up.

The language with the lowest cross-entropy per unit wins. How far to trust it is calibrated: documents set apart are judged by models that
did not see them, once as they are and once without the model of their own language, which makes every answer wrong. A logistic curve over
entropy, lead and length then tells the probability of a right answer; below ``REJECT`` an answer counts as rejected.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .words import mix

ORDER = 4
SLOTS = 1 << 24
MAX_LANGUAGES = 1024
#: At most about so many documents set the curve, and an eighth of all; they count in the final models like all others.
CALIBRATION_DOCUMENTS = 20_000
CALIBRATION_SHARE = 1 / 8
REJECT = 0.5
UNKNOWN = "und"
#: Bits of a unit that no model knows: one of 2 ** 16.
BASE_BITS = 16
SPACE = 32
_PIECE = 1 << 22
_KNOWN = 1 << 20

_COUNTS = "lang string, key long, n long, n_fit long"
_ENTRIES = "lang string, gram int, width int, slot long, a double, b double"
PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean, bits_per_unit double, lead double, n_units long"


# --- texts to windows ----------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _units_table() -> tuple[np.ndarray, np.ndarray]:
    """For every UTF-16 unit what it counts as, and whether it is (part of) a letter."""
    kinds = [unicodedata.category(chr(i)) for i in range(1 << 16)]
    letter = np.array([k[0] == "L" or k == "Cs" for k in kinds])
    kept = np.array([k[0] in "LM" or k == "Cs" for k in kinds])
    return np.where(kept, np.arange(1 << 16), SPACE).astype(np.uint16), letter


def units(text: str | None) -> np.ndarray:
    """The units of a text, with a space at the end; none where it is null or has no letter."""
    counts_as, letter = _units_table()
    lower = (text or "").lower()
    raw = np.frombuffer(lower.encode("utf-16-le"), np.uint16)
    if len(raw) != len(lower):
        # characters of two units: those that are no letters, and only those, go
        raw = np.frombuffer("".join(c if ord(c) < 1 << 16 or c.isalpha() else " " for c in lower).encode("utf-16-le"), np.uint16)
    if not letter[raw].any():
        return np.zeros(0, np.uint16)
    found = counts_as[raw]
    blank = found == SPACE
    kept = ~blank
    kept[1:] |= ~blank[:-1]
    found = found[kept]
    return found if found[-1] == SPACE else np.append(found, np.uint16(SPACE))


def windows(texts: list[np.ndarray]) -> np.ndarray:
    """For each unit of each text the key of the window that ends with it; before a text stand spaces."""
    lead = np.full(ORDER - 1, SPACE, np.uint16)
    line = np.concatenate([x for t in texts for x in (lead, t)] or [lead]).astype(np.uint64)
    if len(line) < ORDER:
        return np.zeros(0, np.uint64)
    n = len(line) - ORDER + 1
    keys = np.zeros(n, np.uint64)
    for k in range(ORDER):
        keys = keys << np.uint64(16) | line[k : k + n]
    ends = np.cumsum([len(t) + ORDER - 1 for t in texts])
    inside = np.ones(len(line), bool)
    inside[(ends[:, None] - np.arange(1, ORDER)).ravel()] = False
    return keys[inside[:n]]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Stretches of rows with the units of their texts, of bounded size apart from single long texts."""
    for batch in batches:
        first, held, size = 0, [], 0
        for i, text in enumerate(batch.column("text")):
            held.append(units(text.as_py()))
            size += len(held[-1])
            if size >= _PIECE or i + 1 == batch.num_rows:
                yield batch.slice(first, i + 1 - first), held
                first, held, size = i + 1, [], 0


# --- counting ------------------------------------------------------------------------------------


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    counts = np.zeros((len(keys), 2), np.int64)
    np.add.at(counts, at, np.concatenate([c for _, c in parts]))
    return keys, counts


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, key, n, n_fit (of the rows that are not set apart): added up per task while they are few."""
    held: dict[str, list] = {}

    def rows(lang: str) -> pa.RecordBatch:
        keys, counts = _merged(held.pop(lang))
        columns = [pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(counts[:, 0]), pa.array(counts[:, 1])]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "key", "n", "n_fit"])

    for batch, texts in _pieces(batches):
        langs, fit = batch.column("lang").to_pylist(), batch.column("fit").to_pylist()
        for lang in sorted(set(langs)):
            for used in (True, False):
                keys, n = np.unique(windows([t for t, x, f in zip(texts, langs, fit) if x == lang and f == used]), return_counts=True)
                if len(keys):
                    held.setdefault(lang, []).append((keys, np.stack([n, n * used], axis=1)))
            if sum(len(k) for k, _ in held.get(lang, ())) > _KNOWN:
                held[lang] = [_merged(held[lang])]
                if len(held[lang][0][0]) > _KNOWN // 2:
                    yield rows(lang)
    for lang in sorted(held):
        yield rows(lang)


def slots(keys: np.ndarray, width: int, bits: int) -> np.ndarray:
    """The hash of windows of ``width`` units."""
    return mix(keys ^ np.uint64(width << 60)) >> np.uint64(64 - bits) if width < ORDER else mix(keys) >> np.uint64(64 - bits)


def _folded(bits: int):
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, width = batch.column("key").to_numpy().view(np.uint64), batch.column("width").to_numpy()
            found = np.zeros(len(keys), np.int64)
            for w in np.unique(width):
                found[width == w] = slots(keys[width == w], int(w), bits).astype(np.int64)
            columns = {c: batch.column(c) for c in ("lang", "gram", "width", "a", "b")}
            yield pa.RecordBatch.from_arrays(
                [columns["lang"], columns["gram"], columns["width"], pa.array(found), columns["a"], columns["b"]], names=["lang", "gram", "width", "slot", "a", "b"]
            )

    return fold


# --- models --------------------------------------------------------------------------------------


@dataclass
class Languages:
    """The models of all languages: ``grams[lang][width]`` (hashes, counts), ``contexts[lang][width]`` (hashes, totals, followers)."""

    names: list[str]
    bits: int
    discounts: np.ndarray
    grams: list[list[tuple]] = field(default_factory=list)
    contexts: list[list[tuple]] = field(default_factory=list)

    def bits_of(self, keys: np.ndarray) -> np.ndarray:
        """A row per language: the bits of the last unit of each window, given those before it."""
        out = np.empty((len(self.names), len(keys)))
        cut = lambda k, width: k & np.uint64((1 << 16 * width) - 1)
        of_gram = [None] + [slots(cut(keys, w), w, self.bits).astype(np.uint32) for w in range(1, ORDER + 1)]
        of_context = [None] + [slots(cut(keys >> np.uint64(16), w), w, self.bits).astype(np.uint32) for w in range(1, ORDER)]
        for i in range(len(self.names)):
            hashes, counts = self.grams[i][1]
            # with no context: against all windows of one unit
            total, p = max(1.0, float(counts.sum())), 2.0**-BASE_BITS
            d = self.discounts[i, 1]
            p = (np.maximum(_found(hashes, of_gram[1], counts) - d, 0) + d * len(hashes) * p) / total
            for w in range(2, ORDER + 1):
                hashes, counts = self.grams[i][w]
                c_hashes, totals, followers = self.contexts[i][w - 1]
                n, all_of, kinds = _found(hashes, of_gram[w], counts), _found(c_hashes, of_context[w - 1], totals), _found(c_hashes, of_context[w - 1], followers)
                d = self.discounts[i, w]
                p = np.where(all_of > 0, (np.maximum(n - d, 0) + d * kinds * p) / np.maximum(all_of, 1), p)
            # windows that fall together may have more counts than their contexts
            out[i] = -np.log2(np.clip(p, 2.0 ** -(2 * BASE_BITS), 1.0))
        return out


def _found(hashes: np.ndarray, wanted: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(hashes):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1)
    return np.where(hashes[at] == wanted, values[at], 0.0)


def _models(counts: DataFrame, count: str, names: list[str], bits: int) -> Languages:
    """Models from the windows of the top order. Only hashed entries, at most ``SLOTS``, come to the driver."""
    tables = [counts.filter(F.col(count) > 0).select("lang", F.lit(ORDER).alias("width"), "key", F.col(count).alias("n"))]
    for width in range(ORDER - 1, 0, -1):
        ends = F.col("key").bitwiseAND(F.lit((1 << 16 * width) - 1).cast("long")).alias("key")
        tables.append(tables[-1].groupBy("lang", ends).agg(F.count("*").alias("n")).select("lang", F.lit(width).alias("width"), "key", "n"))
    grams = tables[0]
    for t in tables[1:]:
        grams = grams.unionByName(t)
    grams = materialize(grams)
    seen = grams.groupBy("lang", "width").agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice")).collect()
    at = {x: i for i, x in enumerate(names)}
    discounts = np.full((len(names), ORDER + 1), 0.5)
    for r in seen:
        if r.once and r.twice:
            discounts[at[r.lang], r.width] = r.once / (r.once + 2 * r.twice)

    context = F.shiftrightunsigned("key", 16).alias("key")
    contexts = grams.filter("width > 1").groupBy("lang", (F.col("width") - 1).alias("width"), context).agg(F.sum("n").alias("a"), F.count("*").alias("b"))
    entry = lambda gram, a, b: ["lang", F.lit(gram).alias("gram"), "width", "key", a.cast("double").alias("a"), b.cast("double").alias("b")]
    entries = grams.select(*entry(1, F.col("n"), F.lit(0))).unionByName(contexts.select(*entry(0, F.col("a"), F.col("b"))))
    table = entries.mapInArrow(_folded(bits), _ENTRIES).groupBy("lang", "gram", "width", "slot").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).toArrow()
    lang = np.array([at[x] for x in table.column("lang").to_pylist()], dtype=np.int32)
    gram, width, slot, a, b = (table.column(c).to_numpy() for c in ("gram", "width", "slot", "a", "b"))

    def entries_of(i: int, is_gram: int, w: int) -> tuple:
        mine = np.flatnonzero((lang == i) & (gram == is_gram) & (width == w))
        mine = mine[np.argsort(slot[mine])]
        values = (a[mine],) if is_gram else (a[mine], b[mine])
        return (slot[mine].astype(np.uint32), *(v.astype(np.float32) for v in values))

    return Languages(
        names, bits, discounts, [[()] + [entries_of(i, 1, w) for w in range(1, ORDER + 1)] for i in range(len(names))],
        [[()] + [entries_of(i, 0, w) for w in range(1, ORDER)] for i in range(len(names))],
    )


class Reader:
    """Total bits of texts under every model; what a window costs is looked up once for many texts."""

    def __init__(self, models: Languages):
        self.models = models
        self.keys, self.costs = np.zeros(0, np.uint64), np.zeros((len(models.names), 0))

    def totals(self, texts: list[np.ndarray]) -> np.ndarray:
        """A row per text, a column per language."""
        sizes = np.array([len(t) for t in texts])
        out = np.zeros((len(texts), len(self.models.names)))
        full = np.flatnonzero(sizes)
        if not len(full):
            return out
        keys, at = np.unique(windows([texts[i] for i in full]), return_inverse=True)
        starts = np.append(0, np.cumsum(sizes[full])[:-1])
        for i, row in enumerate(self._costs(keys)):
            out[full, i] = np.add.reduceat(row[at], starts)
        return out

    def _costs(self, keys: np.ndarray) -> np.ndarray:
        if len(self.keys) > _KNOWN:
            self.keys, self.costs = self.keys[:0], self.costs[:, :0]
        fresh = keys[~np.isin(keys, self.keys, assume_unique=True)]
        if len(fresh):
            both = np.append(self.keys, fresh)
            order = np.argsort(both)
            self.keys, self.costs = both[order], np.append(self.costs, self.models.bits_of(fresh), axis=1)[:, order]
        return self.costs[:, np.searchsorted(self.keys, keys)]


# --- decisions -----------------------------------------------------------------------------------


def evidence(totals: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best language of each text (the first of equals), its bits per unit, and its lead over the next, or over knowing nothing."""
    per_unit = totals / np.maximum(sizes, 1)[:, None]
    best = per_unit.argmin(axis=1)
    least = per_unit[np.arange(len(best)), best]
    others = np.append(per_unit, np.full((len(best), 1), float(BASE_BITS)), axis=1)
    others[np.arange(len(best)), best] = np.inf
    return best, least, others.min(axis=1) - least


def _features(least: np.ndarray, lead: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(least)), least, lead, lead * np.sqrt(np.minimum(sizes, 400)), np.log1p(sizes)], axis=1)


@dataclass
class Curve:
    """A logistic curve over standardised features; without weights, the odds of the lead alone."""

    weights: np.ndarray | None = None
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None

    def probability(self, least: np.ndarray, lead: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        if self.weights is None:
            logit = np.log(2) * lead * sizes
        else:
            logit = (_features(least, lead, sizes) - self.mean) / self.spread @ self.weights
        return 1 / (1 + np.exp(-np.clip(logit, -40, 40)))

    @staticmethod
    def fit(x: np.ndarray, right: np.ndarray, ridge: float = 1.0) -> Curve:
        """Newton's steps on the ridge likelihood."""
        if len(x) < 20 or right.all() or not right.any():
            return Curve()
        mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-9
        mean[0], spread[0] = 0.0, 1.0
        z, w = (x - mean) / spread, np.zeros(x.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w)), z.T @ (right - p) - ridge * w)
            w += step
            if np.abs(step).max() < 1e-9:
                break
        return Curve(w, mean, spread)


def _totals(models):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(models.value)
        for batch, texts in _pieces(batches):
            totals = pa.array(list(reader.totals(texts)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array([len(t) for t in texts], pa.int64()), totals], names=["doc_id", "lang", "n", "totals"])

    return score


def _calibrated(apart: DataFrame, models: Languages) -> Curve:
    """The curve from documents set apart, whose windows ``models`` has not counted. ``apart`` is bounded by ``CALIBRATION_DOCUMENTS``."""
    sent = apart.sparkSession.sparkContext.broadcast(models)
    rows = apart.select("doc_id", "lang", "text").mapInArrow(_totals(sent), "doc_id long, lang string, n long, totals array<double>").filter("n > 0").collect()
    if not rows:
        return Curve()
    rows.sort(key=lambda r: (r.doc_id is None, r.doc_id, r.totals))
    totals, sizes = np.array([r.totals for r in rows]), np.array([r.n for r in rows])
    own = np.array([models.names.index(r.lang) for r in rows])
    best, least, lead = evidence(totals, sizes)
    x, right = [_features(least, lead, sizes)], [best == own]
    totals[np.arange(len(own)), own] = BASE_BITS * sizes
    _, least, lead = evidence(totals, sizes)
    x.append(_features(least, lead, sizes))
    right.append(np.zeros(len(own), bool))
    return Curve.fit(np.concatenate(x), np.concatenate(right))


@dataclass
class Identifier:
    models: Languages
    curve: Curve


def fit_languages(docs: DataFrame) -> Identifier:
    """Models of all values of ``lang`` in ``docs`` (doc_id long, text, lang; rows without lang are left out), and the calibrated curve.

    Every row counts, repeated ones too. Null and empty texts and such without letters add nothing, but their language is learnt. Raises ValueError
    for more than ``MAX_LANGUAGES`` languages.
    """
    docs = docs.filter("lang IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
    found = docs.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    names = sorted(r.lang for r in found)
    # an array per order for windows, and for contexts but the longest
    bits = max(1, (SLOTS // max(1, (2 * ORDER - 1) * len(names))).bit_length() - 1)
    share = min(CALIBRATION_SHARE, CALIBRATION_DOCUMENTS / max(1, sum(r.n for r in found)))
    apart = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) < int(share * (1 << 20))
    counts = docs.select("lang", "text", (~apart).alias("fit")).mapInArrow(_counted, _COUNTS)
    counts = materialize(counts.groupBy("lang", "key").agg(F.sum("n").alias("n"), F.sum("n_fit").alias("n_fit")))
    curve = _calibrated(docs.filter(apart), _models(counts, "n_fit", names, bits))
    return Identifier(_models(counts, "n", names, bits), curve)


def _predict(identifier):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models, curve = identifier.value.models, identifier.value.curve
        reader = Reader(models)
        for batch, texts in _pieces(batches):
            sizes = np.array([len(t) for t in texts])
            known = (sizes > 0) & (len(models.names) > 0)
            best, least, lead = evidence(reader.totals(texts), sizes) if models.names else (np.zeros(len(sizes), int), *np.zeros((2, len(sizes))))
            score = np.where(known, curve.probability(least, lead, sizes), 0.0)
            names = [models.names[b] if k else UNKNOWN for b, k in zip(best, known)]
            none = lambda x: pa.array(x, mask=~known)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names), pa.array(score), pa.array(score < REJECT), none(least), none(lead), pa.array(sizes, pa.int64())],
                names=["doc_id", "held_out", "lang_pred", "score", "rejected", "bits_per_unit", "lead", "n_units"],
            )

    return predict


def identify_languages(docs: DataFrame, held_out: Column) -> DataFrame:
    """``PREDICTED`` for every row of ``docs`` (doc_id long, text, lang), learnt from those that are not held out.

    A null text, one without letters, and every text where no language was learnt are ``und`` with the score 0. Equal entropies go to the
    first language by name. Repeated rows get a result each; other columns are ignored; an empty table gives no rows.
    """
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    identifier = docs.sparkSession.sparkContext.broadcast(fit_languages(marked.filter("NOT held_out")))
    return marked.select("doc_id", "held_out", "text").mapInArrow(_predict(identifier), PREDICTED)


def op12_kneser_ney(spark, sf: str) -> DataFrame:
    """The language of all documents; a fourth of them, by a checksum of the doc_id, is held out."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return identify_languages(spark.read.parquet(f"{sf}/documents.parquet"), checksum % 4 == 2)
