"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recordloom.llm.tables import texts
from recordloom.llm.words import map_batches, slices

ORDER = 3
#: Training text of each language, at most; a fixed pseudo-random choice of the labelled rows.
TRAIN_BYTES = 3_000_000
UNKNOWN = "und"
_FREE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _keys(data: np.ndarray, fresh: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed ``length``-byte strings ending at each position, and where they lie in one text.
    ``fresh`` is each position's index within its text."""
    out = np.zeros(len(data), dtype=np.uint64)
    for j in range(min(length, len(data))):
        out[j:] |= data[:len(data) - j].astype(np.uint64) << np.uint64(8 * j)
    return out, fresh >= length - 1


def _positions(offsets: np.ndarray) -> np.ndarray:
    return np.arange(offsets[-1]) - np.repeat(offsets[:-1], np.diff(offsets))


class HashedRows:
    """Distinct keys to rows of a table, by open addressing in whole arrays."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(8, int(np.ceil(np.log2(max(1, len(keys)) * 2.5))))
        self.keys = np.full(1 << self.bits, _FREE)
        self.rows = np.zeros(1 << self.bits, dtype=np.int32)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = self.keys[slot] == _FREE
            self.keys[slot[free]] = keys[left[free]]
            won = self.keys[slot] == keys[left]
            self.rows[slot[won]] = left[won]
            slot, left = (slot[~won] + 1) & ((1 << self.bits) - 1), left[~won]

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Rows of ``keys``, -1 where there is none."""
        slot = self._slot(keys)
        got = self.keys[slot]
        out = np.where(got == keys, self.rows[slot], -1)
        left = np.flatnonzero((got != keys) & (got != _FREE))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & ((1 << self.bits) - 1)
            got = self.keys[slot]
            same = got == keys[left]
            out[left[same]] = self.rows[slot[same]]
            on = ~same & (got != _FREE)
            left, slot = left[on], slot[on]
        return out


class ByteModels:
    """Frozen PPM models of all languages.

    For order ``k`` the table ``cost[k]`` has the code length in bits of each seen (context, byte)
    for every language, escapes included, and ``escape[k]`` what leaving each seen context costs.
    An escape is weighed by method C; the lower order's distribution is renormalised over the
    bytes the context has not seen, so every context's distribution sums to one.
    """

    def __init__(self, languages: list[str], counts: dict[int, list[dict[int, int]]]):
        self.languages = languages
        self.cost: dict[int, tuple[HashedRows, np.ndarray]] = {}
        self.escape: dict[int, tuple[HashedRows, np.ndarray]] = {}
        for k in range(ORDER + 1):
            by = [c for c in counts[k]]
            keys = np.unique(np.concatenate([np.fromiter(c, dtype=np.uint64, count=len(c)) for c in by]))
            contexts = np.unique(keys >> np.uint64(8))
            at = np.searchsorted(contexts, keys >> np.uint64(8))
            below = self.bits(keys & np.uint64((1 << 8 * k) - 1), k - 1)
            leave = np.zeros((len(contexts), len(languages)))
            cost = np.empty((len(keys), len(languages)))
            for i, c in enumerate(by):
                n = np.fromiter((c.get(int(x), 0) for x in keys), dtype=np.float64, count=len(keys))
                total = np.bincount(at, n, len(contexts))
                kinds = np.bincount(at, n > 0, len(contexts))
                used = np.bincount(at, np.where(n > 0, 2.0 ** -below[:, i], 0), len(contexts))
                known = total > 0
                rest = np.maximum(1 - used, 1e-12)
                leave[known, i] = -np.log2(kinds[known] / (total + kinds)[known]) + np.log2(rest[known])
                seen = n > 0
                cost[:, i] = leave[at, i] + below[:, i]
                cost[seen, i] = -np.log2(n[seen] / (total + kinds)[at[seen]])
            # the last row is for what is not found
            self.cost[k] = HashedRows(keys), np.vstack([cost, np.zeros(len(languages))]).astype(np.float32)
            self.escape[k] = HashedRows(contexts), np.vstack([leave, np.zeros(len(languages))]).astype(np.float32)

    def bits(self, keys: np.ndarray, k: int) -> np.ndarray:
        """Code lengths of (context of ``k`` bytes, byte) for every language."""
        if k < 0:
            return np.full((len(keys), len(self.languages)), 8.0, dtype=np.float32)
        rows, cost = self.cost[k]
        at = rows.find(keys)
        out = cost[at]
        lost = np.flatnonzero(at < 0)
        if len(lost):
            own = keys[lost]
            found, leave = self.escape[k]
            context = found.find(own >> np.uint64(8))
            less = self.bits(own & np.uint64((1 << 8 * k) - 1), k - 1)
            out[lost] = less + leave[context]
        return out

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of every text under every language; the first bytes have shorter contexts."""
        lengths = np.diff(offsets)
        if not len(data):
            return np.zeros((len(lengths), len(self.languages)))
        fresh = _positions(offsets)
        keys, _ = _keys(data, fresh, ORDER + 1)
        bits = self.bits(keys, ORDER)
        for k in range(ORDER):
            early = np.flatnonzero(fresh == k)
            bits[early] = self.bits(keys[early] & np.uint64((1 << 8 * (k + 1)) - 1), k)
        out = np.zeros((len(lengths), len(self.languages)))
        full = lengths > 0
        out[full] = np.add.reduceat(bits, offsets[:-1][full], axis=0, dtype=np.float64)
        return out


def training_rows(docs: DataFrame, learn_from, limit: int = TRAIN_BYTES) -> DataFrame:
    """``lang, text`` of a fixed pseudo-random choice of the labelled rows, about ``limit`` bytes a language.

    Whole texts are taken, at the rate that the bytes of their language allow, and always the one
    of the smallest draw, so a language whose bytes lie in a few long texts is learned too. One
    row per language is broadcast.
    """
    rows = docs.where(learn_from).where("lang IS NOT NULL AND text IS NOT NULL")
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 11) / F.lit(float(1 << 53))
    rate = rows.groupBy(F.col("lang").alias("of")).agg(
        F.least(F.lit(1.0), F.lit(float(limit)) / F.greatest(F.lit(1), F.sum(F.octet_length("text")))).alias("rate"),
        F.min(F.when(F.octet_length("text") > 0, draw)).alias("first"),
    )
    drawn = rows.select("lang", "text", draw.alias("draw")).join(F.broadcast(rate), F.col("lang") == F.col("of"))
    return drawn.where("draw < rate OR draw = first").select("lang", "text")


def train(rows: DataFrame) -> ByteModels | None:
    """Models from ``rows (lang, text)``, or None without rows. Counting is spread over the tasks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            for lang in set(langs.tolist()):
                own = batch.column("text").filter(pa.array(langs == lang))
                for part in slices(own):
                    if not len(part.data):
                        continue
                    fresh = _positions(part.offsets)
                    for k in range(ORDER + 1):
                        keys, whole = _keys(part.data, fresh, k + 1)
                        value, n = np.unique(keys[whole] & np.uint64((1 << 8 * (k + 1)) - 1), return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(value), pa.string()), pa.array(np.full(len(value), k, np.int32)), pa.array(value.astype(np.int64)), pa.array(n.astype(np.int64))],
                            names=["lang", "k", "key", "n"],
                        )

    found = rows.mapInArrow(count, "lang string, k int, key long, n long").groupBy("lang", "k", "key").agg(F.sum("n").alias("n")).toArrow()
    if found.num_rows == 0:
        return None
    lang, k, key, n = (found.column(c).to_numpy(zero_copy_only=False) for c in ("lang", "k", "key", "n"))
    languages = sorted(set(lang.tolist()), key=lambda x: x.encode())
    counts = {o: [dict(zip(key[m].tolist(), n[m].tolist())) for x in languages for m in [(lang == x) & (k == o)]] for o in range(ORDER + 1)}
    return ByteModels(languages, counts)


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True


def with_language(docs: DataFrame, models: ByteModels | None) -> DataFrame:
    """``docs`` with a struct column ``language`` of ``lang_pred`` and ``score``.

    The prediction is the language whose frozen model gives the whole text the shortest code;
    ties go to the language first by code point. ``score`` is the posterior under equal priors,
    with the evidence taken per 16 bytes so that it does not saturate on long texts. ``und``
    with score 0: null text, text without a letter, or nothing to learn from.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def predict(batch: pa.RecordBatch) -> dict[str, object]:
        model, column, out = shared.value, batch.column("text"), []
        for part in slices(column):
            bits = model.code_lengths(part.data, part.offsets) if model else None
            size = np.diff(part.offsets)
            plain = np.concatenate(([0], np.cumsum(_LETTER[part.raw])))
            sure = plain[part.offsets[1:]] > plain[part.offsets[:-1]]
            for i in range(part.rows):
                if model is None or not (sure[i] or has_letter(column[part.first + i].as_py())):
                    out.append({"lang_pred": UNKNOWN, "score": 0.0})
                    continue
                best = int(np.argmin(bits[i]))
                share = np.exp2(-(bits[i] - bits[i][best]) * min(1.0, 16 / size[i]))
                out.append({"lang_pred": model.languages[best], "score": float(1 / share.sum())})
        return {"language": out}

    return map_batches(docs, predict, "language struct<lang_pred: string, score: double>")


def identify(docs: DataFrame, learn_from) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row, learning from the rows where ``learn_from`` holds."""
    models = train(training_rows(docs, learn_from))
    return with_language(texts(docs), models).select("doc_id", "language.*")


def keep_identified(docs: DataFrame, learn_from) -> DataFrame:
    """Rows of ``docs`` whose language can be told, with their own columns only; where nothing is
    labelled, the rows whose text has a letter."""
    models = train(training_rows(docs, learn_from))
    if models is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    own = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in own if c != "text"]).alias("own"), "text")
    kept = with_language(packed, models).where(F.col("language.lang_pred") != UNKNOWN)
    return kept.select(*[F.col("text") if c == "text" else F.col(f"own.`{c}`").alias(c) for c in own])
