"""Benchmark contamination: a broadcast set of test n-grams scanned over the documents' windows."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recordloom.llm.tables import texts
from recordloom.llm.words import PLAIN, grams, map_batches, slices, words

WINDOW = 13
#: Most windows in one broadcast set; a larger benchmark is scanned in several sets.
MAX_WINDOWS = 500_000
NO_ITEMS = hashlib.sha256(b"").hexdigest()


class WindowSet:
    """Windows of the items, by length: sorted hashes, their words and the items that have them."""

    def __init__(self, items: list[tuple[object, str]], window: int):
        self.text: dict[tuple[int, bytes], set] = defaultdict(set)
        self.of: dict[int, dict[int, list[bytes]]] = defaultdict(dict)
        for item, text in items:
            part = next(slices(pa.array([text or ""])))
            found = words(part, PLAIN)
            own = [found.text(i) for i in range(len(found.starts))]
            if not own:
                continue
            k = min(window, len(own))
            for i, h in enumerate(grams(found.hashes(), k).tolist()):
                gram = b" ".join(own[i:i + k])
                if item is not None:
                    self.text[k, gram].add(str(item))
                else:
                    self.text[k, gram]
                same = self.of[k].setdefault(h, [])
                if gram not in same:
                    same.append(gram)
        self.sieve = {}
        for k, by in self.of.items():
            bits = np.zeros(1 << 22, dtype=bool)
            bits[np.fromiter(by, dtype=np.uint64, count=len(by)) >> np.uint64(42)] = True
            self.sieve[k] = bits

    def __len__(self) -> int:
        return len(self.text)

    def hits(self, column: pa.Array) -> tuple[list[int], list[np.ndarray], list[set]]:
        """For each text its number of words, the words inside an occurring window and the items."""
        counts, marks, items = [], [], []
        for part in slices(column):
            found = words(part, PLAIN)
            hashes = found.hashes()
            bounds = found.bounds
            edge = np.zeros(len(hashes) + 1, dtype=np.int32)
            of_row: dict[int, set] = defaultdict(set)
            for k, by in self.of.items():
                rolled = grams(hashes, k)
                for at in np.flatnonzero(self.sieve[k][rolled >> np.uint64(42)]).tolist():
                    same = by.get(int(rolled[at]))
                    if same is None:
                        continue
                    row = int(np.searchsorted(bounds, at, side="right")) - 1
                    if at + k > bounds[row + 1]:
                        continue
                    gram = b" ".join(found.text(i) for i in range(at, at + k))
                    if gram in same:
                        edge[at] += 1
                        edge[at + k] -= 1
                        of_row[row] |= self.text[k, gram]
            hit = np.cumsum(edge[:-1]) > 0
            counts += found.counts().tolist()
            marks += [hit[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
            items += [of_row.get(i, set()) for i in range(part.rows)]
        return counts, marks, items


def window_sets(benchmark: DataFrame, window: int = WINDOW, limit: int = MAX_WINDOWS) -> list:
    """The benchmark's windows as broadcast sets of at most about ``limit`` windows each.

    The number of words bounds the number of windows; it is summed in Spark first. A benchmark
    beyond the limit is dealt out by a hash of its text, and every set is scanned.
    """
    spark = benchmark.sparkSession
    items = benchmark.select("item_id", "text").where("text IS NOT NULL")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = 1 + size // (2 * limit)  # a word takes two characters at least
    out = []
    for i in range(parts):
        own = items if parts == 1 else items.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == i)
        found = WindowSet([tuple(r) for r in own.distinct().toLocalIterator()], window)
        out.append(spark.sparkContext.broadcast(found))
    return out


def with_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, percent: int = 5) -> DataFrame:
    """``docs`` with a struct column ``contamination`` of ``n_words, n_hit, n_items, items_sha256, contaminated``.

    Words are maximal runs of letters, digits and non-ASCII characters, A-Z lower-cased. A
    document word is hit when it lies in any occurrence of a window of ``window`` consecutive
    item words; an item with fewer is one window of its own. A document is contaminated when
    at least ``percent`` of its words are hit. Hash hits are confirmed on the words themselves.

    Null or empty texts have no words and are clean; null or wordless items have no window; an
    item without id marks words but is not counted; repeated items count once.
    """
    sets = window_sets(benchmark, window)

    def scan(batch: pa.RecordBatch) -> dict[str, object]:
        column = batch.column("text")
        counts, marks, items = sets[0].value.hits(column)
        for more in sets[1:]:
            _, m, s = more.value.hits(column)
            marks = [a | b for a, b in zip(marks, m)]
            items = [a | b for a, b in zip(items, s)]
        hit = [int(m.sum()) for m in marks]
        return {
            "contamination": [
                {"n_words": n, "n_hit": h, "n_items": len(s), "items_sha256": hashlib.sha256(",".join(sorted(s)).encode()).hexdigest() if s else NO_ITEMS,
                 "contaminated": h > 0 and 100 * h >= percent * n}
                for n, h, s in zip(counts, hit, items)
            ]
        }

    fields = "contamination struct<n_words: long, n_hit: long, n_items: long, items_sha256: string, contaminated: boolean>"
    return map_batches(docs, scan, fields)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, percent: int = 5) -> DataFrame:
    """One row per document with the fields of :func:`with_contamination`."""
    return with_contamination(texts(docs), benchmark, window, percent).select("doc_id", "contamination.*")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, percent: int = 5) -> DataFrame:
    """Rows of ``docs`` that are not contaminated, with their own columns only."""
    own = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in own if c != "text"]).alias("own"), "text")
    kept = with_contamination(packed, benchmark, window, percent).where("NOT contamination.contaminated")
    return kept.select(*[F.col("text") if c == "text" else F.col(f"own.`{c}`").alias(c) for c in own])


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with the hit words cut out of ``text``; what stands between two cut words goes with them."""
    sets = window_sets(benchmark, window)

    def cut(batch: pa.RecordBatch) -> dict[str, object]:
        column = batch.column("text")
        marks = None
        for s in sets:
            _, m, _ = s.value.hits(column)
            marks = m if marks is None else [a | b for a, b in zip(marks, m)]
        out, row = [], 0
        for part in slices(column):
            found = words(part, PLAIN)
            for i in range(part.rows):
                hit, first = marks[row], found.bounds[i]
                text, at = [], int(part.offsets[i])
                edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
                for a, b in zip(edges[::2], edges[1::2]):
                    text.append(part.raw[at:found.starts[first + a]].tobytes())
                    at = int(found.ends[first + b - 1])
                text.append(part.raw[at:part.offsets[i + 1]].tobytes())
                out.append(b"".join(text).decode())
                row += 1
        return {"cut_text": out}

    done = map_batches(docs, cut, "cut_text string")
    return done.select(*[F.when(F.col("text").isNotNull(), F.col("cut_text")).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
