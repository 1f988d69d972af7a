"""Jaro-Winkler similarity: the one string measure Spark has no built-in for.

Spark does the partitioning and the cheap cases (null, equal, length bound) as column
expressions. The rest goes in Arrow batches to numpy: common characters bound a pair's score,
and what can still reach the lowest threshold is matched for many pairs at once, whatever the
length of the strings.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

# The prefix bonus and the score above which it applies.
PREFIX_WEIGHT = 0.1
PREFIX_LENGTH = 4
BOOST_ABOVE = 0.7

_CELLS = 1 << 19  # characters and alphabet cells of the pairs that are matched at once
_COUNTS = 1 << 22  # cells of the character counts compared at once
_NONE = 1 << 30  # no position
_PARTNERS = 6  # a left string with as many partners is matched with all of them at once
_PLACES = 1 << 20  # characters of a left string and its partners that are compared at once
_LANES = 1 << 15  # characters of pairs whose windows are followed side by side, about


class _Strings:
    """Distinct strings as one run of code points, later of dense character numbers."""

    def __init__(self, values: list[str]) -> None:
        self.length = np.array([len(v) for v in values], dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.codes = np.frombuffer("".join(values).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        self.owner = np.repeat(np.arange(len(values)), self.length)

    def prefix(self, which: np.ndarray) -> np.ndarray:
        """First characters of the chosen strings, minus one behind their end."""
        at = np.arange(PREFIX_LENGTH)
        inside = at < self.length[which][:, None]
        found = self.codes.take(np.where(inside, self.start[which][:, None] + at, 0), mode="clip").astype(np.int64)
        return np.where(inside, found, -1)


def _number_characters(*strings: _Strings) -> int:
    """Replace code points by dense numbers; the size of the alphabet."""
    seen = np.zeros(max(int(s.codes.max()) for s in strings) + 1, dtype=np.int64)
    for s in strings:
        seen[s.codes] = 1
    number = np.cumsum(seen) - 1
    for s in strings:
        s.codes = number[s.codes]
    return int(number[-1]) + 1


def _pieces(weight: np.ndarray, limit: int) -> list[tuple[int, int]]:
    """Consecutive ranges of about ``limit`` summed weight, of at least one element each."""
    total, out, at = np.cumsum(weight), [], 0
    while at < len(weight):
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + limit, side="right")))
        out.append((at, end))
        at = end
    return out


def _common_characters(left: _Strings, right: _Strings, a: np.ndarray, b: np.ndarray, alphabet: int) -> np.ndarray:
    """Characters that the strings of each pair share, with multiplicity. No more than these can match."""
    out = np.zeros(len(a), dtype=np.int64)

    def counts(strings: _Strings, first: int, end: int) -> np.ndarray:
        own = (strings.owner >= first) & (strings.owner < end)
        cells = (strings.owner[own] - first) * alphabet + strings.codes[own]
        return np.bincount(cells, minlength=(end - first) * alphabet).reshape(end - first, alphabet).astype(np.int32)

    step = max(1, _COUNTS // alphabet)
    for i in range(0, len(left.length), step):
        for j in range(0, len(right.length), step):
            own = np.flatnonzero((a >= i) & (a < i + step) & (b >= j) & (b < j + step))
            if len(own):
                x, y = counts(left, i, min(i + step, len(left.length))), counts(right, j, min(j + step, len(right.length)))
                for k in range(0, len(own), step):
                    some = own[k:k + step]
                    out[some] = np.minimum(x[a[some] - i], y[b[some] - j]).sum(axis=1)
    return out


def _jaro(left: _Strings, right: _Strings, a: np.ndarray, b: np.ndarray, alphabet: int) -> np.ndarray:
    """Jaro similarity of the pairs ``left[a], right[b]`` of non-empty strings.

    Of each character, the positions in the left string form a queue: one leaves it when it is
    matched, or when the window of the right string's place has passed it. As the windows only
    move on, the head of the queue is the lowest free position inside or behind the window, so a
    place of the right string takes the head if that is not behind the window, else nothing.
    All pairs of a piece take their steps side by side, those with long right strings first.
    """
    out = np.zeros(len(a))
    key = left.owner * alphabet + left.codes
    order = np.argsort(key, kind="stable")
    place = (np.arange(len(key)) - left.start[left.owner]).astype(np.int32)
    following = np.full(len(key), _NONE, dtype=np.int32)  # next position of the same character
    same = key[order][1:] == key[order][:-1]
    following[order[:-1][same]] = place[order[1:][same]]
    heads = order[np.concatenate(([True], ~same))]
    head_key, head_place = key[heads], place[heads]
    by = np.argsort(-right.length[b], kind="stable")
    for at, end in _pieces(left.length[a[by]] + right.length[b[by]] + alphabet, _CELLS):
        own = by[at:end]
        x, y, n = a[own], b[own], end - at
        p_len, t_len, p_start, t_start = left.length[x], right.length[y], left.start[x], right.start[y]
        reach = np.maximum(np.maximum(p_len, t_len) // 2 - 1, 0)
        row = np.arange(n) * alphabet
        kinds, which = np.unique(x, return_inverse=True)
        queues = np.full((len(kinds), alphabet), _NONE, dtype=np.int32)
        some = np.isin(head_key // alphabet, kinds)
        queues[np.searchsorted(kinds, head_key[some] // alphabet), head_key[some] % alphabet] = head_place[some]
        head = queues[which].ravel()
        width = int(t_len[0])
        hit, taken = np.zeros((width, n), dtype=bool), np.zeros((width, n), dtype=np.int32)
        going = np.searchsorted(-t_len, -np.arange(1, width + 1), side="right")
        last, now, passed = reach.astype(np.int32), t_start.copy(), p_start - reach - 1
        closest = int(reach.min())
        for j in range(width):
            k = going[j]
            if j > closest:
                left_behind = np.flatnonzero((reach[:k] < j) & (p_len[:k] > j - 1 - reach[:k]))
                if len(left_behind):
                    position = passed[left_behind] + j
                    cell = left.codes.take(position) + row[left_behind]
                    front = head.take(cell)
                    head[cell] = np.where(front == position - p_start[left_behind], following.take(position), front)
            cell = right.codes.take(now[:k]) + row[:k]
            front = head.take(cell, out=taken[j, :k], mode="clip")
            found = np.less_equal(front, last[:k], out=hit[j, :k])
            head[cell] = np.where(found, following.take(p_start[:k] + front, mode="clip"), front)
            now += 1
            last += 1
        hit, taken = np.ascontiguousarray(hit.T), taken.T
        pair, t_place = np.nonzero(hit)
        p_first = np.cumsum(p_len) - p_len
        matched = np.zeros(int(p_len.sum()), dtype=bool)
        matched[p_first[pair] + taken[hit]] = True
        # both sides list their matched characters in order, equally many for each pair
        differs = left.codes[np.flatnonzero(matched) + (p_start - p_first)[pair]] != right.codes[t_start[pair] + t_place]
        m = np.bincount(pair, minlength=n).astype(float)
        swaps = np.bincount(pair, weights=differs, minlength=n).astype(np.int64) // 2
        some = m > 0
        m, found = m[some], np.zeros(n)
        found[some] = (m / p_len[some] + m / t_len[some] + (m - swaps[some]) / m) / 3.0
        out[own] = found
    return out


class _Ranked:
    """Strings sorted out by character: of every place its rank among the places of its character."""

    def __init__(self, strings: _Strings, alphabet: int) -> None:
        self.length, self.start, self.owner = strings.length, strings.start, strings.owner
        key = strings.owner * alphabet + strings.codes
        self.order = np.argsort(key, kind="stable")
        counts = np.bincount(key, minlength=len(strings.length) * alphabet)
        self.first = (np.cumsum(counts) - counts).reshape(-1, alphabet)
        rank = np.empty(len(key), dtype=np.int32)
        rank[self.order] = np.arange(len(key)) - self.first.ravel()[key[self.order]]
        self.most = int(rank.max()) + 1
        small = np.int16 if self.most < 1 << 15 else np.int32
        self.rank, self.counts = rank.astype(small), counts.reshape(-1, alphabet).astype(small)
        self.place = (np.arange(len(key)) - strings.start[strings.owner]).astype(np.int32)
        self.sorted_place = self.place[self.order]
        self.codes = strings.codes.astype(np.uint8 if alphabet <= 256 else np.int32)


def _spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers from each ``first`` on, ``n`` of them."""
    ends = np.cumsum(n)
    return np.arange(int(ends[-1]) if len(n) else 0) + np.repeat(first - ends + n, n)


def _windows(p: _Ranked, t: _Ranked, lanes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The matches of single characters of pairs, ``lanes`` (left, right, character): lane, left place, right place.

    Either side lists its places of the character. The first two match if they are no further apart
    than the window reaches; if they are, the lower one matches nothing.
    """
    x, y, c = lanes
    i, j = p.first[x, c], t.first[y, c]
    i_end, j_end = i + p.counts[x, c], j + t.counts[y, c]
    reach = np.maximum(np.maximum(p.length[x], t.length[y]) // 2 - 1, 0)
    lane, found = np.arange(len(x)), []
    while len(lane):
        apart = p.sorted_place[i] - t.sorted_place[j]
        hit = np.abs(apart) <= reach
        found.append((lane[hit], i[hit], j[hit]))
        i, j = i + (hit | (apart < 0)), j + (hit | (apart > 0))
        going = (i < i_end) & (j < j_end)
        if not going.all():
            lane, i, j, i_end, j_end, reach = (v[going] for v in (lane, i, j, i_end, j_end, reach))
    lane, i, j = (np.concatenate(v) for v in zip(*found))
    return lane, p.order[i], t.order[j]


def _jaro_of_many(left: _Strings, right: _Strings, a: np.ndarray, b: np.ndarray, alphabet: int) -> np.ndarray:
    """:func:`_jaro` for left strings with many partners, whose characters are compared in one run.

    If no window kept any apart, the places of a character would match by their rank on either side,
    as many as the side with fewer has. That is found for a left string and all its partners with a few
    look-ups. Where a window does keep such a match apart, mostly of rare characters, the places of this
    character are followed one by one, for many pairs side by side.
    """
    p, t = _Ranked(left, alphabet), _Ranked(right, alphabet)
    pairs, back = np.unique(a * len(t.length) + b, return_inverse=True)
    x, y = np.divmod(pairs, len(t.length))
    out = np.zeros(len(pairs))
    most = max(p.most, t.most)
    table = np.full(alphabet * most, -1, dtype=np.int32)
    own_key, key = (s.codes.astype(np.int64) * most + s.rank for s in (p, t))
    edges = np.concatenate((np.flatnonzero(np.diff(x, prepend=-1)), [len(x)]))
    groups = []
    for at, end in zip(edges[:-1], edges[1:]):
        wide = np.maximum(t.length[y[at:end]], p.length[x[at]])
        groups += [(at + i, at + j) for i, j in _pieces(wide, _PLACES)]
    waiting: list[tuple] = []
    held = 0

    def partners(at: int, end: int) -> tuple[np.ndarray, np.ndarray | slice, np.ndarray | slice]:
        """Right strings of a piece, and their characters, as slices if they lie side by side. Gaps are
        filled with others, whose results are not used, if that costs less than leaving them out."""
        own = y[at:end]
        first, last = own[0], own[-1] + 1
        if t.start[last - 1] + t.length[last - 1] - t.start[first] <= 1.6 * t.length[own].sum():
            return np.arange(first, last), slice(first, last), slice(t.start[first], t.start[last - 1] + t.length[last - 1])
        return own, own, _spread(t.start[own], t.length[own])

    def finish() -> None:
        lanes = np.concatenate([w[4] for w in waiting], axis=1)
        edges = np.cumsum([0] + [w[4].shape[1] for w in waiting])
        if lanes.shape[1]:
            lane, p_hit, t_hit = _windows(p, t, lanes)
            by = np.argsort(lane, kind="stable")
            lane, p_hit, t_hit = lane[by], p_hit[by], t_hit[by]
            hits = np.searchsorted(lane, edges)
        for k, (at, end, (ids, which, places), taken, own) in enumerate(waiting):
            one, n = x[at], len(ids)
            first, size = p.start[one], p.length[one]
            mine, theirs = p.codes[first:first + size], t.counts[which]
            given = p.rank[first:first + size] < theirs.take(mine, axis=1)
            m = np.minimum(theirs, p.counts[one]).sum(axis=1, dtype=np.int64)
            if own.shape[1]:
                _, z, c = own
                row = np.searchsorted(ids, z)
                begin = np.cumsum(t.length[which]) - t.length[which]
                shift = begin[row] - t.start[z]  # of a character of the right side to its place in this run
                n_t, n_p = t.counts[z, c].astype(np.int64), p.counts[one, c].astype(np.int64)
                taken[t.order[_spread(t.first[z, c], n_t)] + np.repeat(shift, n_t)] = False
                given[np.repeat(row, n_p), p.place[p.order[_spread(p.first[one, c], n_p)]]] = False
                some = slice(hits[k], hits[k + 1])
                at_lane = lane[some] - edges[k]
                taken[t_hit[some] + shift[at_lane]] = True
                given[row[at_lane], p.place[p_hit[some]]] = True
                m += np.bincount(row, np.bincount(at_lane, minlength=len(z)) - np.minimum(n_t, n_p), n).astype(np.int64)
            differs = np.zeros(int(m.sum()) + 1, dtype=np.int32)
            np.cumsum(t.codes[places][taken] != np.tile(mine, n)[given.ravel()], out=differs[1:])
            ends = np.cumsum(m)
            swaps = (differs[ends] - differs[ends - m]) // 2
            some = m > 0
            m, found = m[some].astype(float), np.zeros(n)
            found[some] = (m / size + m / t.length[which][some] + (m - swaps[some]) / m) / 3.0
            out[at:end] = found[y[at:end] - ids[0]] if isinstance(which, slice) else found
        waiting.clear()

    for at, end in groups:
        ids, which, places = partners(at, end)
        one = x[at]
        first, size = p.start[one], p.length[one]
        table[own_key[first:first + size]] = p.place[first:first + size]
        partner = table.take(key[places])
        table[own_key[first:first + size]] = -1
        lengths = t.length[which]
        reach = np.maximum(np.maximum(lengths, size) // 2 - 1, 0).astype(np.int32)
        taken = partner >= 0
        partner -= t.place[places]
        late = np.flatnonzero((np.abs(partner, out=partner) > np.repeat(reach, lengths)) & taken)
        late = late + places.start if isinstance(places, slice) else places[late]
        kinds = np.unique(t.owner[late] * alphabet + t.codes[late])
        waiting.append((at, end, (ids, which, places), taken, np.stack([np.full(len(kinds), one), kinds // alphabet, kinds % alphabet])))
        held += len(kinds) + len(taken) // 512
        if held >= _LANES:
            finish()
            held = 0
    if waiting:
        finish()
    return out[back]


def _boosted(jaro: np.ndarray, prefix: np.ndarray | int) -> np.ndarray:
    return np.where(jaro > BOOST_ABOVE, np.minimum(jaro + prefix * PREFIX_WEIGHT * (1.0 - jaro), 1.0), jaro)


def _scores(left: list[str], right: list[str], a: np.ndarray, b: np.ndarray, at_least: float | None) -> np.ndarray:
    """Jaro-Winkler of ``left[a], right[b]``; not a number where it is known to be below ``at_least``."""
    out = np.zeros(len(a))
    p, t = _Strings(left), _Strings(right)
    live = np.flatnonzero((p.length[a] > 0) & (t.length[b] > 0))
    if not len(live):
        return out
    alphabet = _number_characters(p, t)
    a, b = a[live], b[live]
    if at_least is not None:
        common = _common_characters(p, t, a, b, alphabet)
        bound = _boosted((common / p.length[a] + common / t.length[b] + 1.0) / 3.0, PREFIX_LENGTH)
        fine = bound >= at_least - 1e-12
        out[live[~fine]] = np.nan
        live, a, b = live[fine], a[fine], b[fine]
        if not len(live):
            return out
    jaro = np.empty(len(a))
    many = (np.bincount(a)[a] >= _PARTNERS) & (alphabet * (len(left) + len(right)) <= _COUNTS * 4)
    for some, measure in ((np.flatnonzero(many), _jaro_of_many), (np.flatnonzero(~many), _jaro)):
        if len(some):
            jaro[some] = measure(p, t, a[some], b[some], alphabet)
    high = np.flatnonzero(jaro > BOOST_ABOVE)
    x, y = p.prefix(a[high]), t.prefix(b[high])
    prefix = np.cumprod((x == y) & (x >= 0), axis=1).sum(axis=1)
    jaro[high] = _boosted(jaro[high], prefix)
    out[live] = jaro
    return out


def jaro_winkler_pairs(first: list[str], second: list[str]) -> np.ndarray:
    """Jaro-Winkler of aligned lists; an empty string scores 0."""
    at = np.arange(len(first))
    return _scores(first, second, at, at, None)


def similarities(values: pa.Array, first: np.ndarray, second: np.ndarray, at_least: float | None = None) -> np.ndarray:
    """Jaro-Winkler of ``values[first], values[second]``; not a number where it is known to be below ``at_least``."""
    (x, a), (y, b) = (np.unique(side, return_inverse=True) for side in (first, second))
    return _scores(values.take(pa.array(x)).to_pylist(), values.take(pa.array(y)).to_pylist(), a, b, at_least)


@cache
def _measure(at_least: float | None):
    # marked so that the optimiser never evaluates it a second time below a filter on its result
    @F.arrow_udf("double")
    def jaro_winkler_of(first: pa.Array, second: pa.Array) -> pa.Array:
        rows = np.flatnonzero(first.is_valid().to_numpy(zero_copy_only=False) & second.is_valid().to_numpy(zero_copy_only=False))
        out, known = np.zeros(len(first)), np.zeros(len(first), dtype=bool)
        if len(rows):
            # pairs of a block repeat their strings, so each is read once
            p, t = (side.take(pa.array(rows)).dictionary_encode() for side in (first, second))
            a, b = (side.indices.to_numpy().astype(np.int64) for side in (p, t))
            pairs, back = np.unique(a * len(t.dictionary) + b, return_inverse=True)
            found = _scores(p.dictionary.to_pylist(), t.dictionary.to_pylist(), pairs // len(t.dictionary), pairs % len(t.dictionary), at_least)[back]
            out[rows], known[rows] = found, ~np.isnan(found)
        return pa.array(out, mask=~known)

    return jaro_winkler_of.asNondeterministic()


def jaro_winkler(a: Column, b: Column) -> Column:
    """Jaro-Winkler similarity as a column; null when either side is null."""
    return _measure(None)(a, b)


def similarity_upper_bound(a: Column, b: Column) -> Column:
    """No pair of these lengths can score higher than this."""
    shorter, longer = F.least(F.length(a), F.length(b)), F.greatest(F.length(a), F.length(b))
    jaro = (F.lit(2.0) + shorter / F.greatest(longer, F.lit(1))) / F.lit(3.0)
    boosted = jaro + F.lit(PREFIX_LENGTH * PREFIX_WEIGHT) * (F.lit(1.0) - jaro)
    return F.when(jaro > BOOST_ABOVE, boosted).otherwise(jaro)


def jaro_winkler_above(a: Column, b: Column, at_least: float) -> Column:
    """Similarity for pairs that differ and can still reach ``at_least``; null for the rest.

    Nulls reach the Python worker for skipped rows, so it does no work for them.
    """
    needed = (a != b) & (similarity_upper_bound(a, b) >= at_least)
    return _measure(float(at_least))(F.when(needed, a), F.when(needed, b))
