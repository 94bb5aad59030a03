"""Edit distance of two sequences, up to a limit; for many pairs at once, which of them may stay within it."""

from __future__ import annotations

from collections import Counter

import numpy as np

_CODES = 251  # elements are told apart by this many codes; the codes above stand for none
_PAIRS = 2048  # pairs whose columns are filled at once
_CELLS = 1 << 21  # of their longest sequences, at most
_LONGEST = 1 << 12  # elements; the columns of longer pairs, or of few long ones, cost more side by side than one by one
_FEW, _SHORT = 16, 256
_ALL, _ONE = np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(1)


def codes_of(elements: np.ndarray) -> np.ndarray:
    """Elements as the codes that ``may_be_within`` takes: equal ones have equal codes."""
    return (elements % elements.dtype.type(_CODES)).astype(np.uint8)


def _filled(codes: np.ndarray, start: np.ndarray, size: np.ndarray, width: int, none: int) -> np.ndarray:
    """The sequences as rows of ``width``, ``none`` behind their ends."""
    at = np.arange(width)
    inside = at < size[:, None]
    return np.where(inside, codes[np.where(inside, start[:, None] + at, 0)], np.uint8(none))


def _column_step(same: np.ndarray, plus: np.ndarray, minus: np.ndarray, up: np.ndarray, down: np.ndarray):
    """One column of 64 rows as bit vectors: (plus, minus, up, down) below ``up`` and ``down``, the step of the row above."""
    xv = same | minus
    same = same | down
    xh = (((same & plus) + plus) ^ plus) | same
    rise, fall = minus | ~(xh | plus), plus & xh
    below = rise >> np.uint64(63), fall >> np.uint64(63)
    rise, fall = (rise << _ONE) | up, (fall << _ONE) | down
    return fall | ~(xv | rise), rise & xv, *below


def _reachable(codes: np.ndarray, start_a, size_a, start_b, size_b, limit) -> np.ndarray:
    """``may_be_within`` of pairs of about the same size."""
    count, width, words = len(limit), int(size_b.max()), -(-int(size_a.max()) // 64)
    ok, own = np.ones(count, dtype=bool), np.arange(count)
    a = _filled(codes, start_a, size_a, 64 * words, _CODES + 1).reshape(count, words, 64)
    b = np.ascontiguousarray(_filled(codes, start_b, size_b, width, _CODES + 2).T)
    plus, minus = np.full((words, count), _ALL), np.zeros((words, count), dtype=np.uint64)
    above = np.zeros(count, dtype=np.int32)  # distance in the row above the first word in use
    # Words first to last - 1 hold the rows that a path within the limit may pass: its first row never
    # falls, its last one rises by one a column. What lies outside counts one more a step, which is too much at worst.
    first, last, lowest, seen, look = 0, 0, int(limit.max()), 0, max(8, width // 16)
    for j in range(1, width + 1):
        before, last = last, max(first + 1, min(words, (lowest + j - seen - 1) // 64 + 1))
        plus[before:last], minus[before:last] = _ALL, 0
        up, down = np.ones(len(own), dtype=np.uint64), np.zeros(len(own), dtype=np.uint64)
        for w in range(first, last):
            same = np.packbits(a[:, w] == b[j - 1][:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
            plus[w], minus[w], up, down = _column_step(same, plus[w], minus[w], up, down)
        above = above + 1
        if j % look or j <= limit.min():
            continue
        bits = [np.unpackbits(np.ascontiguousarray(v[first:last].T).view(np.uint8), axis=1, bitorder="little").view(np.int8) for v in (plus, minus)]
        reach = np.empty((len(own), 64 * (last - first) + 1), dtype=np.int32)
        reach[:, 0] = 0
        np.cumsum(bits[0] - bits[1], axis=1, out=reach[:, 1:])
        reach += above[:, None]
        # what is left of both costs at least the difference of their sizes
        row = np.arange(64 * first, 64 * last + 1, dtype=np.int32)
        within = reach + np.abs((size_a - size_b + j).astype(np.int32)[:, None] - row) <= limit.astype(np.int32)[:, None]
        inside = row <= size_a[:, None]
        within &= inside
        can = within.any(axis=1) | (size_b < j)
        ok[own[~can]] = False
        # spared: the last columns, and those of pairs that are rather alike, which are not ruled out here
        stay = can & (size_b >= j + look) & (4 * np.where(inside, reach, j).min(axis=1) >= j)
        if not stay.any():
            break
        rows = np.flatnonzero(within[stay].any(axis=0))
        lowest, seen, drop = int(row[rows[-1]]), j, min(int(row[rows[0]]) // 64, last - 1) - first
        above, first = reach[:, 64 * drop], first + drop
        last = max(first + 1, min(last, (lowest - 1) // 64 + 1))
        if stay.mean() < 0.8:
            own, a, b, plus, minus, above = own[stay], a[stay], np.ascontiguousarray(b[:, stay]), plus[:, stay], minus[:, stay], above[stay]
            size_a, size_b, limit = size_a[stay], size_b[stay], limit[stay]
    return ok


def may_be_within(codes: np.ndarray, start: np.ndarray, size: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Of each pair, False only if its distance is above ``limit``.

    ``codes``: the elements of all sequences (``codes_of``), ``start`` and ``size``: (2, pairs).
    The columns of many pairs are filled side by side, until no row of a pair's column
    can end within its limit; unlike pairs go after about half their columns, and pairs that
    look alike so far are passed on, as are very long ones.
    """
    ok = np.abs(size[0] - size[1]) <= limit
    some = np.flatnonzero(ok & (size.min(axis=0) > 0))
    some = some[np.lexsort((size[0][some], size[1][some]))]
    at = 0
    while at < len(some):
        longest = np.maximum(size[0], size[1])[some[at: at + _PAIRS]]
        fits = np.maximum.accumulate(longest) * np.arange(1, len(longest) + 1) <= _CELLS
        own = some[at: at + max(1, int(fits.sum()))]
        at += len(own)
        if longest[0] <= _LONGEST and (len(own) >= _FEW or longest[0] <= _SHORT):
            ok[own] = _reachable(codes, start[0][own], size[0][own], start[1][own], size[1][own], limit[own])
    return ok


def _trimmed(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the common start and the common end."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    start = int(differ[0]) if len(differ) else n
    a, b = a[start:], b[start:]
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[len(a) - n:][::-1] != b[len(b) - n:][::-1])
    end = int(differ[0]) if len(differ) else n
    return a[: len(a) - end], b[: len(b) - end]


def _banded(a: np.ndarray, b: np.ndarray, x: list, y: list, band: int) -> int | None:
    """The distance if it is at most ``band``: the furthest point of each
    diagonal of the band that 0, 1, 2, ... edits reach. ``x``, ``y``: the same
    sequences as lists, for single looks."""
    m, n = len(x), len(y)
    goal = n - m
    if abs(goal) > band:
        return None

    def run(i: int, k: int) -> int:
        """Furthest row on diagonal k reached from row i by equal elements."""
        end = min(m, n - k)
        stop = min(end, i + 4)
        while i < stop:
            if x[i] != y[i + k]:
                return i
            i += 1
        size = 32
        while i < end:
            stop = min(end, i + size)
            differ = a[i:stop] != b[i + k: stop + k]
            at = int(differ.argmax())
            if differ[at]:
                return i + at
            i, size = stop, 4 * size
        return i

    reach = {0: run(0, 0)}
    for edits in range(band + 1):
        if reach.get(goal, -1) >= m:
            return edits
        if edits == band:
            return None
        wider = {}
        for k in range(max(-m, -edits - 1), min(n, edits + 1) + 1):
            # a diagonal further from the goal's than edits are left for cannot come back
            if abs(k - goal) > band - edits - 1:
                continue
            i = min(max(reach.get(k - 1, -1), reach.get(k, -2) + 1, reach.get(k + 1, -2) + 1), m, n - k)
            if i >= max(0, -k):
                wider[k] = run(i, k)
        reach = wider
    return None


def _bits(x: int, m: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(x.to_bytes(-(-m // 8), "little"), np.uint8), bitorder="little")[:m].astype(np.int64)


def _bitwise(a: list, b: list, limit: int) -> int:
    """Distance by whole columns as bit vectors (for wide bands), or a number above ``limit``.

    Now and then the column is written out: from row i the rest costs at least
    the difference of what is left of both, and where no row can do it the rest is spared.
    """
    m, where = len(a), {}
    look = max(32, m // 8)  # columns between two looks
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full, last = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    for j, x in enumerate(b):
        if j and j % look == 0:
            column = j + np.concatenate(([0], np.cumsum(_bits(plus, m) - _bits(minus, m))))
            if (column + np.abs(np.arange(m, -1, -1) - (len(b) - j))).min() > limit:
                return limit + 1
        same = where.get(x, 0)
        xv = same | minus
        xh = (((same & plus) + plus) ^ plus) | same
        up = (minus | ~(xh | plus)) & full
        down = plus & xh
        if up & last:
            score += 1
        elif down & last:
            score -= 1
        up = (up << 1 | 1) & full
        down = down << 1 & full
        plus = (down | ~(xv | up)) & full
        minus = up & xv
    return score


def distance_within(a: np.ndarray, b: np.ndarray, limit: int) -> int | None:
    """Edit distance (insert, delete, replace) if it is at most ``limit``, else None.

    The band doubles while the distance does not fit it and a wider band is
    cheaper than whole columns, so alike sequences cost little more than a look.
    """
    a, b = _trimmed(a, b)
    longer = max(len(a), len(b))
    if abs(len(a) - len(b)) > limit:
        return None
    if not len(a) or not len(b):
        return longer
    x, y = a.tolist(), b.tolist()
    band = min(8, limit)
    found = _banded(a, b, x, y, band)
    if found is not None or band == limit:
        return found
    if longer - sum((Counter(x) & Counter(y)).values()) > limit:  # what has no partner costs an edit each
        return None
    columns = longer * (1 + longer / 5000)  # microseconds, about
    while band < limit and 4 * (2 * band) ** 2 < columns:
        band = min(2 * band, limit)
        found = _banded(a, b, x, y, band)
        if found is not None:
            return found
    if band == limit:
        return None
    found = _bitwise(x, y, limit) if len(x) <= len(y) else _bitwise(y, x, limit)
    return found if found <= limit else None


def _runs(v: np.ndarray, size: int) -> np.ndarray:
    """A number for each run of ``size`` elements; equal runs have equal ones."""
    n = max(len(v) - size + 1, 0)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        out = out * np.uint64(0x9E3779B97F4A7C15) + v[i: i + n].astype(np.uint64)
    return out


def _anchored(a: np.ndarray, b: np.ndarray, run: int = 1) -> int:
    """Cost of one alignment, an upper bound of the distance: elements (runs of ``run``
    elements) that occur once in each sequence, in the same order, are set against each
    other, and between two of these what stands at the same place after the first."""
    keys = (a, b) if run == 1 else (_runs(a, run), _runs(b, run))
    (va, ia, na), (vb, ib, nb) = (np.unique(v, return_index=True, return_counts=True) for v in keys)
    _, ka, kb = np.intersect1d(va[na == 1], vb[nb == 1], assume_unique=True, return_indices=True)
    at_a, at_b = ia[na == 1][ka], ib[nb == 1][kb]
    order = np.argsort(at_a)
    at_a, at_b = at_a[order], at_b[order]
    if len(at_b):  # only those that stand after all before them and before all after them
        inside = (at_b == np.maximum.accumulate(at_b)) & (at_b == np.minimum.accumulate(at_b[::-1])[::-1])
        at_a, at_b = at_a[inside], at_b[inside]
    starts_a, starts_b = np.concatenate(([0], at_a)), np.concatenate(([0], at_b))
    ends_a, ends_b = np.append(at_a, len(a)), np.append(at_b, len(b))
    size_a, size_b = ends_a - starts_a, ends_b - starts_b
    segment = np.repeat(np.arange(len(size_a)), size_a)
    j = np.arange(len(a)) - starts_a[segment] + starts_b[segment]
    there = j < ends_b[segment]
    differ = a[there] != b[j[there]]
    return int(differ.sum()) + int((~there).sum()) + int(np.maximum(size_b - size_a, 0).sum())


def surely_alike(a: np.ndarray, b: np.ndarray, similarity: float, run: int = 1) -> bool:
    """True only for sequences that are ``alike``: an alignment along common unique elements
    (runs of ``run``) settles most of these."""
    limit = int((1 - similarity) * max(len(a), len(b)) + 1e-9)
    if abs(len(a) - len(b)) > limit:
        return False
    a, b = _trimmed(a, b)
    return max(len(a), len(b)) <= limit or _anchored(a, b, run) <= limit


def alike(a: np.ndarray, b: np.ndarray, similarity: float, run: int = 1) -> bool:
    """Whether 1 - distance / length of the longer is at least ``similarity``.

    The banded alignment decides where ``surely_alike`` does not.
    """
    limit = int((1 - similarity) * max(len(a), len(b)) + 1e-9)
    return surely_alike(a, b, similarity, run) or distance_within(a, b, limit) is not None
