"""Words of whole Arrow batches as arrays: boundaries, 64-bit hashes and rolling k-grams.

Texts are handled as their UTF-8 bytes, in slices of bounded size, without a Python object
per word. Only A-Z are lower-cased. Every byte above 127 belongs to a word in both patterns,
so byte classes and code-point classes agree.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SLICE_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Pattern ``[^\x20\x09-\x0D]+``.
SPACED = np.ones(256, dtype=bool)
SPACED[[9, 10, 11, 12, 13, 32]] = False
#: Pattern ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing.
PLAIN = np.zeros(256, dtype=bool)
PLAIN[0x30:0x3A] = PLAIN[0x61:0x7B] = PLAIN[0x80:] = True

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_Q = np.uint64(0xD6E8FEB86659FD93)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that is a permutation of the 64-bit integers."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_CODE = mix64(np.arange(1, 257, dtype=np.uint64) * _P)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, SLICE_BYTES + 1)
        inverse = np.uint64(pow(int(_P), -1, 1 << 64))
        for name, base in (("up", _P), ("down", inverse)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.cumprod(steps, dtype=np.uint64)
    return _POWERS["up"][:n], _POWERS["down"][:n]


@dataclass
class Slice:
    """Some rows of a batch. ``data`` holds their bytes, A-Z lower-cased; row ``i`` is
    ``data[offsets[i]:offsets[i + 1]]``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray
    raw: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    """``starts`` and ``ends`` of all words; row ``i`` has the words ``bounds[i]`` to ``bounds[i + 1]``."""

    part: Slice
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def hashes(self) -> np.ndarray:
        if not len(self.starts):
            return np.zeros(0, dtype=np.uint64)
        up, down = _powers(len(self.part.data) + 1)
        total = np.zeros(len(self.part.data) + 1, dtype=np.uint64)
        np.cumsum(_CODE[self.part.data] * up[:-1], out=total[1:])
        return mix64((total[self.ends] - total[self.starts]) * down[self.starts])

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def rows(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(self.part.rows), self.counts())

    def text(self, i: int) -> bytes:
        return self.part.data[self.starts[i]:self.ends[i]].tobytes()


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Rows of a string column in slices of about ``limit`` bytes; null counts as empty. A text
    longer than that is a slice of its own, whole."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0:
        return
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    body = texts.buffers()[2]
    raw = np.frombuffer(body, dtype=np.uint8) if body is not None and body.size else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        end = min(end, len(texts))
        own = raw[offsets[at]:offsets[end]]
        yield Slice(at, LOWER[own], offsets[at:end + 1] - offsets[at], own)
        at = end


def words(part: Slice, member: np.ndarray) -> Words:
    """Maximal runs of bytes in ``member``; a row's end always ends a word."""
    inside = member[part.data]
    n = len(inside)
    before = np.zeros(n, dtype=bool)
    after = np.zeros(n, dtype=bool)
    before[1:] = inside[:-1]
    after[:-1] = inside[1:]
    firsts = part.offsets[:-1]
    firsts = firsts[firsts < n]
    before[firsts] = False
    after[firsts[firsts > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(part, starts, ends, np.searchsorted(starts, part.offsets))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` consecutive words from each position, also across rows."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, np.uint64(k))
    for j in range(k):
        out *= _Q
        out += hashes[j:j + n]
    return mix64(out)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, object]], fields: str, keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` (all of ``df`` by default) and the ones ``fn`` computes, row by row of each batch.

    ``fields`` is a DDL list of what ``fn`` returns. The kept columns are passed on as they are.
    """
    keep = df.columns if keep is None else keep
    added = T._parse_datatype_string(fields)
    schema = T.StructType([df.schema[c] for c in keep] + added.fields)
    arrow = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            got = fn(batch)
            columns = [batch.column(c) for c in keep] + [pa.array(got[f.name], type=f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *arrow.names])

    return df.mapInArrow(run, schema)
