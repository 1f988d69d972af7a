"""Pairs of packed blocks, compared without being spelled out first.

A cell has its rows side by side, so a string goes to Python once for all of its pairs and its
similarity to another is measured once in a cell, however many pairs of rows have the two. Only
what a caller asks for leaves Python: level columns of all pairs, their counts per pattern, or
the pairs that can reach a threshold.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, types as T

from recordloom.functions.similarity import similarities
from recordloom.operators.blocking import COPIES, PID, PackedPairs, packed_cells
from recordloom.operators.model import Comparison, MatchModel, needed_weight
from recordloom.settings import DATA_SOURCE

_LARGE = 1 << 13  # a cell of so many pairs is compared as a matrix, smaller ones as one list of pairs
_PAIRS = 1 << 20  # pairs that are compared at once
_ROWS = 1 << 16  # pairs told in one batch
_SLACK = 1e-3  # weights are added up in single precision, then Spark adds them up again and decides


class _Rows:
    """The rows of a batch of cells, left ones first, with numbers instead of values."""

    def __init__(self, batch: pa.RecordBatch, pairs: PackedPairs, columns: Sequence[str]) -> None:
        sides = [batch.column(side) for side in "lr"]
        sizes = [pc.fill_null(pc.list_value_length(s), 0).to_numpy(zero_copy_only=False).astype(np.int64) for s in sides]
        self.rows = pa.RecordBatch.from_struct_array(pa.concat_arrays([s.flatten() for s in sides]))
        ends = [np.cumsum(n) for n in sizes]
        shift = int(ends[0][-1])
        self.left = np.stack([ends[0] - sizes[0], ends[0]], axis=1)
        self.right = np.stack([ends[1] - sizes[1], ends[1]], axis=1) + shift
        self.alone = sides[1].is_null().to_numpy(zero_copy_only=False)
        self.right[self.alone] = self.left[self.alone]
        self.rule = batch.column("rule").to_numpy()
        self.cell = -1  # the large cell that is read
        self.tables: dict[tuple[str, float], tuple] = {}
        self.values: dict[str, list] = {}
        self.codes: dict[str, np.ndarray] = {}
        for name in {*columns, PID, *([pairs.apart] if pairs.apart else []), *([DATA_SOURCE] if pairs.link_type != "link_and_dedupe" else [])}:
            self._number(name)
        ids = self.values[PID]
        rank = np.empty(len(ids), dtype=np.int64)
        rank[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
        self.order = rank[self.codes[PID]]
        self.copies = self.rows.column(COPIES).to_numpy()
        met = self.rows.column("_met").to_numpy()
        self.keys = []
        for i, rule in enumerate(pairs.rules[:-1]):
            key = np.zeros(self.rows.num_rows, dtype=np.int64)
            for k in rule.keys:
                code = self._number(pairs.held(k))
                key = np.unique(key * (int(code.max(initial=0)) + 2) + code + 1, return_inverse=True)[1]
            self.keys.append(np.where((met >> i) & 1 == 1, key, -1))

    def _number(self, name: str) -> np.ndarray:
        if name not in self.codes:
            found = self.rows.column(name).dictionary_encode()
            self.codes[name] = found.indices.fill_null(-1).to_numpy().astype(np.int64)
            self.values[name] = found.dictionary
        return self.codes[name]

    def floats(self, name: str) -> np.ndarray:
        """A column of numbers, not a number where it is null."""
        return self.rows.column(name).to_numpy(zero_copy_only=False).astype(float)


def _pieces(rows: _Rows) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Left rows, right rows, which of them are a pair, and the rule, for some pairs at a time: as the
    sides of a matrix for a large cell, else as lists."""
    size = rows.right[:, 1] - rows.right[:, 0]
    n = (rows.left[:, 1] - rows.left[:, 0]) * size
    large = np.where(rows.alone, n // 2, n) >= _LARGE
    for cell in np.flatnonzero(large):
        rows.cell = int(cell)
        step = max(1, _PAIRS // int(size[cell]))
        b = np.arange(*rows.right[cell])[None, :]
        for at in range(*rows.left[cell], step):
            a = np.arange(at, min(at + step, rows.left[cell, 1]))[:, None]
            yield a, b, a < b if rows.alone[cell] else np.ones((len(a), b.shape[1]), dtype=bool), rows.rule[cell]
    small = np.flatnonzero(~large)
    if not len(small):
        return
    length = rows.left[small, 1] - rows.left[small, 0]
    begin = np.cumsum(length) - length
    own = np.arange(int(length.sum())) + np.repeat(rows.left[small, 0] - begin, length)
    cell = np.repeat(small, length)
    first, last = np.where(rows.alone[cell], own + 1, rows.right[cell, 0]), rows.right[cell, 1]
    total = np.cumsum(last - first)
    at = 0
    while at < len(own):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + _PAIRS, side="right")))
        count = last[at:end] - first[at:end]
        a = np.repeat(own[at:end], count)
        b = np.arange(int(count.sum())) + np.repeat(first[at:end] - (np.cumsum(count) - count), count)
        yield a, b, np.ones(len(a), dtype=bool), np.repeat(rows.rule[cell[at:end]], count)
        at = end


def _live(rows: _Rows, pairs: PackedPairs, a: np.ndarray, b: np.ndarray, live: np.ndarray, rule: np.ndarray) -> np.ndarray:
    """Leaves out pairs of a rule before, and those the link type or ``apart`` leaves out."""
    live &= rows.order[a] != rows.order[b]
    for i, key in enumerate(rows.keys):
        here = rule > i
        if np.any(here):
            live &= ~((key[a] == key[b]) & (key[a] >= 0) & here)
    if pairs.apart:
        live &= rows.codes[pairs.apart][a] != rows.codes[pairs.apart][b]
    if pairs.link_type != "link_and_dedupe":
        same = rows.codes[DATA_SOURCE][a] == rows.codes[DATA_SOURCE][b]
        live &= same if pairs.link_type == "dedupe" else ~same
    return live


def _fuzzy(rows: _Rows, c: Comparison, a: np.ndarray, b: np.ndarray, needed: np.ndarray, at_least: float) -> np.ndarray:
    """Level of each pair of unequal values ``a`` and ``b`` where ``needed``; 0 for what is below ``at_least``.

    For a large cell the levels of its values are kept while its pieces are read.
    """
    values = rows.values[c.column]

    def levels(first: np.ndarray, second: np.ndarray) -> np.ndarray:
        # the measure is the same both ways
        kinds, back = np.unique(np.minimum(first, second) * len(values) + np.maximum(first, second), return_inverse=True)
        found = similarities(values, *np.divmod(kinds, len(values)), at_least)
        return sum((found >= t).astype(np.int8) for t in c.thresholds)[back]

    if a.ndim == 1:
        out = np.zeros(len(a), dtype=np.int8)
        some = np.flatnonzero(needed)
        if len(some):
            out[some] = levels(a[some], b[some])
        return out
    cell, u, v, table = rows.tables.get((c.column, at_least), (-1, None, None, None))
    if cell != rows.cell:
        u, v = (np.unique(rows.codes[c.column][slice(*side[rows.cell])]) for side in (rows.left, rows.right))
        table = np.full((len(u), len(v)), -1, dtype=np.int8)
        rows.tables[c.column, at_least] = rows.cell, u, v, table
    i, j = np.searchsorted(u, a[:, 0]), np.searchsorted(v, b[0])
    asked = np.zeros(table.shape, dtype=bool)
    x, y = np.nonzero(needed)
    asked[i[x], j[y]] = True
    x, y = np.nonzero(asked & (table < 0))
    if len(x):
        found = levels(u[x], v[y])
        table[x, y] = found
        if rows.alone[rows.cell]:
            table[y, x] = found
    return np.maximum(table, 0).take(i, axis=0).take(j, axis=1)


def _level(rows: _Rows, c: Comparison, a: np.ndarray, b: np.ndarray, wanted: Sequence[tuple[np.ndarray, float]]) -> np.ndarray:
    """Level column ``c`` of pairs; ``wanted`` are the pairs to be measured, and the similarity from which on."""
    x, y = rows.codes[c.column][a], rows.codes[c.column][b]
    equal, missing = x == y, (x < 0) | (y < 0)
    out = np.zeros(equal.shape, dtype=np.int8)
    if c.thresholds:
        for mask, at_least in wanted:
            out = np.maximum(out, _fuzzy(rows, c, x, y, mask & ~equal & ~missing, at_least))
    out[equal] = c.exact_level
    out[missing] = -1
    return out


def _all_levels(rows: _Rows, comparisons: Sequence[Comparison], a: np.ndarray, b: np.ndarray, live: np.ndarray) -> list[np.ndarray]:
    return [_level(rows, c, a, b, [(live, min(c.thresholds, default=0.0))]) for c in comparisons]


def _reaching(rows: _Rows, model: MatchModel, threshold: float, a: np.ndarray, b: np.ndarray, live: np.ndarray) -> list[np.ndarray]:
    """Levels of the pairs that stay ``live``, which is changed: those whose weight can be enough.

    What is not measured yet is taken at its most favourable, so a pair that fails then is not measured,
    and only above the highest threshold if nothing below would do.
    """
    needed = needed_weight(threshold) - _SLACK
    best = np.full(live.shape, model.prior_weight, dtype=np.float32)
    factors, exact, upper = {}, {}, {}
    for c in model.comparisons:
        f = factors[c] = np.array([model.log_factor(c, g) for g in c.levels], dtype=np.float32)
        x, y = rows.codes[c.column][a], rows.codes[c.column][b]
        top = f[-1]
        _, u = model.parameters.get(c.column, {}).get(c.exact_level, (None, None))
        if c.term_frequency and u is not None:
            with np.errstate(divide="ignore"):
                own = np.log2(u / rows.floats(f"tf_{c.column}")).astype(np.float32)
            top = top + np.nan_to_num(np.fmin(own[a], own[b]), nan=0.0)
        exact[c] = top
        upper[c] = np.where((x < 0) | (y < 0), np.float32(0), np.where(x == y, top, f[:-1].max()))
        best += upper[c]
    live &= best >= needed
    out = []
    for c in model.comparisons:
        f, wanted = factors[c], []
        if c.thresholds and live.any():
            low = live & (best - upper[c] + f[:-2].max() >= needed)
            wanted = [(low, min(c.thresholds)), (live & ~low, max(c.thresholds))]
        level = _level(rows, c, a, b, [w for w in wanted if w[0].any()])
        weight = np.where(level == c.exact_level, exact[c], np.where(level < 0, np.float32(0), f[level]))
        best += weight - upper[c]
        live &= best >= needed
        out.append(level)
    return out


def _spelled(rows: _Rows, a: np.ndarray, b: np.ndarray, live: np.ndarray) -> tuple[tuple[np.ndarray, ...], np.ndarray, np.ndarray]:
    """Where the live pairs are, and their rows, the lesser id first."""
    at = np.nonzero(live)
    x, y = (a[at], b[at]) if a.ndim == 1 else (a[at[0], 0], b[0, at[1]])
    turned = rows.order[x] > rows.order[y]
    return at, np.where(turned, y, x), np.where(turned, x, y)


def _read(pairs: PackedPairs, columns: Sequence[str], schema: str | T.StructType, tell: Callable) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from tell(_Rows(batch, pairs.bare(), columns))

    # the function goes to the tasks, the frames do not
    cells, pairs = packed_cells(pairs), pairs.bare()
    return cells.mapInArrow(run, schema)


def _pair_schema(pairs: PackedPairs, keep: Sequence[str], gammas: Sequence[str]) -> T.StructType:
    row = T.StructType([pairs.rows.schema[name] for name in keep])
    return T.StructType([T.StructField("rule", T.StringType()), T.StructField("l", row), T.StructField("r", row), T.StructField("n_pairs", T.LongType()),
                         *[T.StructField(g, T.IntegerType()) for g in gammas]])


def _told(rows: _Rows, names: pa.Array, keep: Sequence[str], gammas: Sequence[str], a, b, live, rule, levels) -> Iterator[pa.RecordBatch]:
    at, left, right = _spelled(rows, a, b, live)
    own = rows.rows.select(list(keep))
    for i in range(0, len(left), _ROWS):
        some = slice(i, i + _ROWS)
        x, y = left[some], right[some]
        which = np.broadcast_to(rule, live.shape)[tuple(v[some] for v in at)]
        columns = [names.take(pa.array(which)), *[own.take(pa.array(v)).to_struct_array() for v in (x, y)], pa.array(rows.copies[x] * rows.copies[y])]
        columns += [pa.array(v[tuple(w[some] for w in at)].astype(np.int32)) for v in levels]
        yield pa.RecordBatch.from_arrays(columns, names=["rule", "l", "r", "n_pairs", *gammas])


def vectors(pairs: PackedPairs, comparisons: Sequence[Comparison], keep: Sequence[str] = (PID,)) -> DataFrame:
    """``rule, l, r, n_pairs`` and the level columns of all pairs; ``l`` and ``r`` have the columns ``keep``."""
    gammas, names, bare = [c.gamma for c in comparisons], pa.array([r.name for r in pairs.rules]), pairs.bare()

    def tell(rows: _Rows) -> Iterator[pa.RecordBatch]:
        for a, b, live, rule in _pieces(rows):
            live = _live(rows, bare, a, b, live, rule)
            yield from _told(rows, names, keep, gammas, a, b, live, rule, _all_levels(rows, comparisons, a, b, live))

    columns = [c.column for c in comparisons]
    return _read(pairs.holding({*columns, *keep}), columns, _pair_schema(pairs, keep, gammas), tell)


def patterns(pairs: PackedPairs, comparisons: Sequence[Comparison]) -> DataFrame:
    """Level columns and ``n``: record pairs per pattern, of each batch of cells."""
    gammas, bare = [c.gamma for c in comparisons], pairs.bare()
    wide = [len(c.levels) + 1 for c in comparisons]

    def tell(rows: _Rows) -> Iterator[pa.RecordBatch]:
        found = np.zeros(math.prod(wide), dtype=np.int64)
        seen = np.zeros(len(found), dtype=bool)
        for a, b, live, rule in _pieces(rows):
            live = _live(rows, bare, a, b, live, rule)
            code = np.zeros(live.shape, dtype=np.int16 if len(found) < 1 << 15 else np.int64)
            for n, level in zip(wide, _all_levels(rows, comparisons, a, b, live)):
                code *= n
                code += level
                code += 1
            own, n_pairs = code[live], (rows.copies[a] * rows.copies[b])[live]
            if n_pairs.sum(dtype=float) < 1 << 52:
                found += np.bincount(own, n_pairs, len(found)).astype(np.int64)
            else:
                np.add.at(found, own, n_pairs)
            seen |= np.bincount(own, minlength=len(found)) > 0
        at = np.flatnonzero(seen)
        levels = np.unravel_index(at, wide)
        yield pa.RecordBatch.from_arrays([*[pa.array(v.astype(np.int32) - 1) for v in levels], pa.array(found[at])], names=[*gammas, "n"])

    columns = [c.column for c in comparisons]
    schema = ", ".join([*[f"{g} int" for g in gammas], "n bigint"])
    return _read(pairs.holding(set(columns)), columns, schema, tell)


def reaching(pairs: PackedPairs, model: MatchModel, threshold: float, keep: Sequence[str]) -> DataFrame:
    """:func:`vectors` of the pairs whose weight may reach ``threshold``."""
    gammas, names, bare = [c.gamma for c in model.comparisons], pa.array([r.name for r in pairs.rules]), pairs.bare()

    def tell(rows: _Rows) -> Iterator[pa.RecordBatch]:
        for a, b, live, rule in _pieces(rows):
            live = _live(rows, bare, a, b, live, rule)
            levels = _reaching(rows, model, threshold, a, b, live)
            yield from _told(rows, names, keep, gammas, a, b, live, rule, levels)

    columns = [c.column for c in model.comparisons]
    frequencies = {f"tf_{c.column}" for c in model.comparisons if c.term_frequency}
    return _read(pairs.holding({*columns, *keep, *frequencies}), columns, _pair_schema(pairs, keep, gammas), tell)
