"""Toxicity by weak supervision: voters, a generative label model, a linear classifier on its posteriors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from recordloom.llm.language import HashedRows
from recordloom.llm.tables import texts
from recordloom.llm.words import PLAIN, Slice, Words, map_batches, mix64, slices, words

#: Labelled rows that are learned from, about; a fixed pseudo-random choice.
TRAIN_ROWS = 16_000
#: Whole words, and word beginnings of so many bytes, are lexicon entries.
PREFIXES = (4, 5, 6, 7, 8, 9)
KINDS = 1 + len(PREFIXES)
LEXICON = 4096
LEAST_DOCS, LEAST_Z = 4, 3.5
_NAMES = ("symbols", "shouting", "exclamation", "digits", "repeats", "length")
#: Evidence by kind: distinct entries, hits, largest and summed log-odds, one, two and three hits, hits per word.
_EVIDENCE = 8
WIDTH = _EVIDENCE * KINDS + len(_NAMES)


def keys_of(found: Words) -> list[np.ndarray]:
    """Per kind the key of each word; 0 where the word is not longer than the prefix."""
    part = found.part
    whole = found.hashes()
    out = [whole | np.uint64(1)]
    size = found.ends - found.starts
    for n in PREFIXES:
        code = np.zeros(len(size), dtype=np.uint64)
        fits = np.flatnonzero(size > n)
        at = found.starts[fits]
        own = np.full(len(fits), np.uint64(n))
        for j in range(n):
            own = own * np.uint64(0x100000001B3) + part.data[at + j]
        code[fits] = mix64(own) | np.uint64(1)
        out.append(code)
    return out


def patterns(part: Slice, found: Words) -> np.ndarray:
    """Shares of symbols, capitals, exclamation marks, digits and repeated words, and the log length, per row."""
    edges = part.offsets
    size = np.maximum(np.diff(edges), 1)

    def share(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask)))
        return (total[edges[1:]] - total[edges[:-1]]) / size

    raw = part.raw
    symbols = (raw > 32) & (raw < 128) & ~PLAIN[part.data]
    hashes = found.hashes()
    same = np.zeros(len(hashes), dtype=bool)
    same[1:] = hashes[1:] == hashes[:-1]
    runs = np.concatenate(([0], np.cumsum(same)))[found.bounds]
    return np.stack([
        share(symbols), share((raw >= 65) & (raw <= 90)), share(raw == 33), share((raw >= 48) & (raw <= 57)),
        np.diff(runs) / np.maximum(found.counts(), 1), np.log1p(found.counts()) / 10,
    ], axis=1)


@dataclass
class Lexicon:
    rows: HashedRows
    kind: np.ndarray
    odds: np.ndarray

    def hits(self, found: Words) -> np.ndarray:
        """Per row and kind: distinct entries, all hits, the largest and the summed log-odds of distinct entries."""
        n = found.part.rows
        out = np.zeros((n, KINDS, 4))
        of = found.rows()
        for k, key in enumerate(keys_of(found)):
            at = self.rows.find(key)
            spot = np.flatnonzero((at >= 0) & (key != 0))
            spot = spot[self.kind[at[spot]] == k]
            if not len(spot):
                continue
            np.add.at(out[:, k, 1], of[spot], 1)
            pair = np.unique(of[spot].astype(np.int64) * (len(self.odds) + 1) + at[spot])
            row, entry = pair // (len(self.odds) + 1), pair % (len(self.odds) + 1)
            np.add.at(out[:, k, 0], row, 1)
            np.maximum.at(out[:, k, 2], row, self.odds[entry])
            np.add.at(out[:, k, 3], row, self.odds[entry])
        return out


def mine(sample: DataFrame) -> Lexicon:
    """Entries that stand in clearly more toxic than clean texts of ``sample (text, toxic)``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(bool)
            for part in slices(batch.column("text")):
                found = words(part, PLAIN)
                of = found.rows().astype(np.uint64)
                for k, key in enumerate(keys_of(found)):
                    used = key != 0
                    pair = np.unique(np.rec.fromarrays([key[used], of[used]], names="key,row"))
                    if not len(pair):
                        continue
                    flag = toxic[part.first + pair["row"].astype(np.int64)]
                    entry, back = np.unique(pair["key"], return_inverse=True)
                    bad = np.bincount(back, flag, len(entry)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(entry.view(np.int64)), pa.array(np.full(len(entry), k, np.int32)), pa.array(bad), pa.array(np.bincount(back, minlength=len(entry)) - bad)],
                        names=["entry", "kind", "bad", "good"],
                    )

    n_bad, n_good = (int(x or 0) for x in sample.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") == 0)).first())
    sums = sample.select("text", "toxic").mapInArrow(count, "entry long, kind int, bad long, good long").groupBy("entry", "kind").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    odds = F.ln((F.col("bad") + 0.25) / (n_bad + 0.5)) - F.ln((F.col("good") + 0.25) / (n_good + 0.5))
    z = odds / F.sqrt(1 / (F.col("bad") + 0.25) + 1 / (F.col("good") + 0.25))
    best = sums.where(F.col("bad") >= LEAST_DOCS).select("entry", "kind", odds.alias("odds"), z.alias("z")).where((F.col("z") > LEAST_Z) | ((F.col("odds") > 3) & (F.col("z") > 2)))
    got = best.orderBy(F.desc("z"), "entry").limit(LEXICON).toArrow()
    entry = got.column("entry").to_numpy().view(np.uint64)
    entry, first = np.unique(entry, return_index=True)
    return Lexicon(HashedRows(entry), got.column("kind").to_numpy()[first], got.column("odds").to_numpy()[first])


def features(lexicon: Lexicon, column: pa.Array) -> np.ndarray:
    """Voters' evidence of each text: hits by kind and the patterns."""
    out = []
    for part in slices(column):
        found = words(part, PLAIN)
        hits = lexicon.hits(found)
        total, rate = hits[:, :, 1], hits[:, :, 1] / np.maximum(found.counts(), 20)[:, None]
        out.append(np.concatenate([
            np.log1p(hits[:, :, 0]), np.log1p(total), hits[:, :, 2], np.log1p(hits[:, :, 3]), total >= 1, total >= 2, total >= 3, np.sqrt(rate), patterns(part, found)
        ], axis=1))
    return np.concatenate(out) if out else np.zeros((0, WIDTH))


def votes(x: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """+1, 0 or -1 of each voter: per kind for one, two and three hits and for a telling entry, per pattern beyond its limits;
    a voter without a hit votes -1, a pattern within its limits abstains."""
    kind = x[:, :_EVIDENCE * KINDS].reshape(len(x), _EVIDENCE, KINDS)
    one, two, three, best = kind[:, 4] > 0, kind[:, 5] > 0, kind[:, 6] > 0, kind[:, 2]
    own = [np.where(one, 1, -1), np.where(two, 1, np.where(one, 0, -1)), np.where(three, 1, np.where(two, 0, -1)), np.where(best > 3, 1, -1)]
    pattern = x[:, _EVIDENCE * KINDS:]
    return np.concatenate([*own, np.where(pattern > limits, 1, 0)], axis=1).astype(np.int8)


@dataclass
class LabelModel:
    """Naive generative model with a dependency tree: each voter depends on the label and on one other voter.

    The tree links the voters that agree most beyond what the label explains, so that voters
    that repeat each other do not count twice. Fitted by EM; a labelled row's label is one more
    voter of accuracy ``TRUST``.
    """

    parent: np.ndarray
    table: np.ndarray
    prior: float

    TRUST = 0.97

    def log_odds(self, v: np.ndarray) -> np.ndarray:
        at = v.astype(np.int64) + 1
        total = np.full(len(v), np.log(self.prior) - np.log1p(-self.prior))
        for j, p in enumerate(self.parent):
            above = at[:, p] if p >= 0 else np.zeros(len(v), dtype=np.int64)
            t = self.table[j]
            total += np.log(t[1, above, at[:, j]]) - np.log(t[0, above, at[:, j]])
        return total

    @classmethod
    def fit(cls, v: np.ndarray, label: np.ndarray, rounds: int = 12) -> LabelModel:
        n, m = v.shape
        q = np.where(label == 1, cls.TRUST, 1 - cls.TRUST)
        model = cls(np.full(m, -1), np.zeros((m, 2, 3, 3)), 0.5)
        at = v.astype(np.int64) + 1
        known = np.log(cls.TRUST / (1 - cls.TRUST)) * np.where(label == 1, 1, -1)
        for _ in range(rounds):
            model.prior = float(np.clip(q.mean(), 1e-3, 0.999))
            model.parent = cls._tree(at, q)
            for j, p in enumerate(model.parent):
                above = at[:, p] if p >= 0 else np.zeros(n, dtype=np.int64)
                for y, weight in ((0, 1 - q), (1, q)):
                    seen = np.bincount(above * 3 + at[:, j], weight, 9).reshape(3, 3) + 0.5
                    model.table[j, y] = seen / seen.sum(axis=1, keepdims=True)
            q = 1 / (1 + np.exp(-np.clip(model.log_odds(v) + known, -30, 30)))
        return model

    @staticmethod
    def _tree(at: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Maximum spanning tree of the mutual information given the label."""
        n, m = at.shape
        hot = (at[:, :, None] == np.arange(3)).reshape(n, 3 * m).astype(np.float64)
        gain = np.zeros((m, m))
        for weight in (q, 1 - q):
            total = weight.sum() + 1e-9
            joint = ((hot * weight[:, None]).T @ hot / total).reshape(m, 3, m, 3).transpose(0, 2, 1, 3) + 1e-9
            single = joint.sum(axis=3).mean(axis=1)
            gain += total / n * (joint * np.log(joint / (single[:, None, :, None] * single[None, :, None, :]))).sum(axis=(2, 3))
        parent, inside = np.full(m, -1), {0}
        while len(inside) < m:
            i, j = max(((i, j) for i in inside for j in range(m) if j not in inside), key=lambda e: (gain[e], -e[0], -e[1]))
            parent[j] = i
            inside.add(j)
        return parent


@dataclass
class Classifier:
    """Linear classifier over the standardised features."""

    lexicon: Lexicon
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float

    def score(self, column: pa.Array) -> np.ndarray:
        x = (features(self.lexicon, column) - self.mean) / self.scale
        return 1 / (1 + np.exp(-np.clip(x @ self.weight + self.bias, -40, 40)))


def fit_linear(x: np.ndarray, q: np.ndarray, penalty: float = 1e-3, steps: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Logistic regression on probabilities ``q`` by Newton steps."""
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.concatenate([(x - mean) / scale, np.ones((len(x), 1))], axis=1)
    w = np.zeros(z.shape[1])
    ridge = np.full(z.shape[1], penalty * len(x))
    ridge[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -40, 40)))
        gradient = z.T @ (q - p) - ridge * w
        curve = (z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z + np.diag(ridge)
        step = np.linalg.solve(curve, gradient)
        w += step * min(1.0, 5 / (np.abs(step).max() + 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return mean, scale, w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, learn_from: Column, limit: int = TRAIN_ROWS) -> Classifier | None:
    """A classifier from about ``limit`` labelled rows, or None if a class is missing among them.

    The chosen label rows are few by that bound and are broadcast. The lexicon is mined on one
    half of them and the models are fitted on the other, whose features are collected.
    """
    known = labels.where(learn_from).where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = known.count()
    draw = F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(float(1 << 53))
    chosen = known.where(draw * F.lit(float(max(n, 1))) < limit)
    sample = texts(docs).join(F.broadcast(chosen), "doc_id").withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)))
    lexicon = mine(sample.where("half = 0"))
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    wide = map_batches(sample.select("doc_id", "text", "toxic", "half"), lambda b: {"x": list(features(shared.value, b.column("text")))}, "x array<double>", keep=["doc_id", "toxic", "half"])
    got = wide.orderBy("doc_id").toArrow()
    if got.num_rows == 0:
        return None
    x, label = np.array(got.column("x").to_pylist()), got.column("toxic").to_numpy()
    own = got.column("half").to_numpy() == 1
    if len(set(label[own].tolist())) < 2:
        own[:] = True
    if len(set(label.tolist())) < 2:
        return None
    x, label = x[own], label[own]
    v = votes(x, np.quantile(x[:, _EVIDENCE * KINDS:], 0.95, axis=0))
    model = LabelModel.fit(v, label)
    known_odds = np.log(LabelModel.TRUST / (1 - LabelModel.TRUST)) * np.where(label == 1, 1, -1)
    q = 1 / (1 + np.exp(-np.clip(model.log_odds(v) + known_odds, -30, 30)))
    return Classifier(lexicon, *fit_linear(x, q))


def with_toxicity(docs: DataFrame, classifier: Classifier | None) -> DataFrame:
    """``docs`` with a column ``toxicity`` between 0 and 1; null text counts as empty; 0 without a classifier."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def one(batch: pa.RecordBatch) -> dict[str, object]:
        model = shared.value
        return {"toxicity": model.score(batch.column("text")) if model else np.zeros(batch.num_rows)}

    return map_batches(docs, one, "toxicity double")


def score(docs: DataFrame, labels: DataFrame, learn_from: Column, threshold: float = 0.3) -> DataFrame:
    """``doc_id, score, predicted`` of every row of ``docs``, learned from the label rows where ``learn_from`` holds.

    Only the text is an input of a score. Repeated ids in ``labels`` count as toxic if one row
    says so; null labels and ids are not learned from. Null ids and repeated rows of ``docs`` are
    scored like others. Other columns are ignored.
    """
    found = with_toxicity(texts(docs), train(docs, labels, learn_from))
    return found.select("doc_id", F.col("toxicity").alias("score"), (F.col("toxicity") >= threshold).cast("int").alias("predicted"))
