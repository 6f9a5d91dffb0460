"""Time-warping distances of arrays, their lower bounds, and the pairs within limits, in numpy.

Distances follow the usual definition: squared local cost, square root of the sum, a band of
``radius`` around the diagonal that is widened by the difference in length.
"""

from __future__ import annotations

import math

import numpy as np

CANDIDATES_AT_ONCE = 8_192
MET_AT_ONCE = 65_536  # pairs of rows that go through the stages together
FEW = 1_024  # so many pairs are bounded and measured without stages
STAGE = 8  # items of the shorter sequences after which pairs that are too far already are dropped
ROW_BYTES = 65_536  # of one row of the distance tables; the rows within the band then fit the processor cache
SINGLE_MAX = 1e15  # squares of larger numbers, added up, might not fit single precision


_SPACE: dict = {}


def _space(name: str, kind: type, *shape: int) -> np.ndarray:
    """An array without values that calls use again; new memory for each of them costs as much as the sums in it."""
    size, held = math.prod(shape), _SPACE.get((name, kind))
    if held is None or len(held) < size:
        held = _SPACE[name, kind] = np.empty(size, kind)
    return held[:size].reshape(shape)


def _tables(kind: type, band: list[range], m: int, pairs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The row above the distance tables of so many pairs, the next row and its costs; items are lines."""
    above, row = (_space(name, kind, m + 2, pairs) for name in ("above", "row"))
    above[0], above[1:], row[:] = 0.0, np.inf, np.inf
    return above, row, _space("cost", kind, max(map(len, band), default=0), pairs)


def _band(n: int, m: int, radius: int) -> list[range]:
    """Columns of the longer sequence that each item of the shorter one may meet."""
    reach = m - n + radius
    return [range(max(0, i - radius), min(m, i + reach + 1)) for i in range(n)]


def dtw_rows(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Distance of a[p] and b[p] for every row p; in single precision if both are."""
    if a.shape[1] > b.shape[1]:
        a, b = b, a
    kind = np.float32 if a.dtype == b.dtype == np.float32 else np.float64
    out, size = np.empty(len(a), kind), ROW_BYTES // np.dtype(kind).itemsize
    for start in range(0, len(a), size):
        out[start : start + size] = _dtw_some(a[start : start + size], b[start : start + size], radius, kind)
    return out


def _next_row(above: np.ndarray, row: np.ndarray, item: np.ndarray, others: np.ndarray, columns: range, cost: np.ndarray) -> None:
    """The next row of the distance tables, from ``above``: of an item of each pair and the ``others`` that it may meet, one a line."""
    start, stop = columns.start, columns.stop
    cells, cost = row[start + 1 : stop + 1], cost[: stop - start]
    np.minimum(above[start:stop], above[start + 1 : stop + 1], out=cells)
    np.subtract(item, others, out=cost)
    np.multiply(cost, cost, out=cost)
    # the two rows are reused, so what lies beside the band is made unreachable
    row[start], row[stop + 1] = np.inf, np.inf
    before = cells[0]
    before += cost[0]
    for cell, more in zip(cells[1:], cost[1:]):
        np.minimum(cell, before, out=cell)
        cell += more
        before = cell


def _dtw_some(a: np.ndarray, b: np.ndarray, radius: int, kind: type) -> np.ndarray:
    pairs, n, m = len(a), a.shape[1], b.shape[1]
    x, y = _space("x", kind, n, pairs), _space("y", kind, m, pairs)
    x[:], y[:] = a.T, b.T
    band = _band(n, m, radius)
    above, row, cost = _tables(kind, band, m, pairs)
    for item, columns in zip(x, band):
        _next_row(above, row, item, y[columns.start : columns.stop], columns, cost)
        above, row = row, above
    return np.sqrt(above[m])


def _envelope(long: np.ndarray, band: list[range]) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest of the items that each item of a shorter sequence may meet, one item a line."""
    lines = np.ascontiguousarray(long.T)
    least, largest = (np.empty((len(band), len(long)), long.dtype) for _ in range(2))
    for i, columns in enumerate(band):
        lines[columns.start : columns.stop].min(axis=0, out=least[i])
        lines[columns.start : columns.stop].max(axis=0, out=largest[i])
    return least, largest


def _add_outside(total: np.ndarray, gap: np.ndarray, item: np.ndarray, least: np.ndarray, largest: np.ndarray) -> None:
    """Add the squares of what an item of the rows lies outside the ranges of the columns."""
    item = item[:, None]
    np.minimum(item, largest[None, :], out=gap)
    np.maximum(gap, least[None, :], out=gap)
    np.subtract(gap, item, out=gap)
    np.multiply(gap, gap, out=gap)
    total += gap


def _outside_envelope(short: np.ndarray, long: np.ndarray, radius: int) -> np.ndarray:
    """Squared lower bound, items of ``short`` against the envelope of ``long`` in the band."""
    total = np.zeros((short.shape[0], long.shape[0]), np.result_type(short, long))
    gap = np.empty_like(total)
    for item, least, largest in zip(short.T, *_envelope(long, _band(short.shape[1], long.shape[1], radius))):
        _add_outside(total, gap, item, least, largest)
    return total


def _in_stages(a: np.ndarray, b: np.ndarray, limits: np.ndarray, radius: int, allowed: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Places of the pairs within the limit of their row of ``a``, measured in the precision of the rows.

    A pair is given up where the least cell that its table has reached, and what the items still to come lie outside
    the other's envelope, add up to more than its limit.
    """
    if a.shape[1] > b.shape[1]:
        short, long, squares = b, a, np.broadcast_to((limits * limits).astype(a.dtype)[None, :], (len(b), len(a)))
        allowed = None if allowed is None else allowed.T
    else:
        short, long, squares = a, b, np.broadcast_to((limits * limits).astype(a.dtype)[:, None], (len(a), len(b)))
    n, m, kind = short.shape[1], long.shape[1], short.dtype
    band, lines = _band(n, m, radius), (np.ascontiguousarray(short.T), np.ascontiguousarray(long.T))
    least, largest = _envelope(long, band)
    stops, rows, found = [*range(STAGE, n - 2, STAGE), n], max(1, MET_AT_ONCE // max(1, len(long))), []
    for start in range(0, len(short), rows):
        part = slice(start, start + rows)
        shape = len(short[part]), len(long)
        total, gap, rest = _space("total", kind, *shape), _space("gap", kind, *shape), {}
        total[:] = 0.0
        for i in range(n - 1, -1, -1):
            if i + 1 in stops:
                rest[i + 1] = _space(f"rest {i}", kind, *shape)
                rest[i + 1][:] = total
            _add_outside(total, gap, lines[0][i, part], least[i], largest[i])
        maybe = total <= squares[part]
        if allowed is not None:
            maybe &= allowed[part]
        at = np.flatnonzero(maybe)
        p, q = np.divmod(at, len(long))
        (above, row, cost), i = _tables(kind, band, m, len(at)), 0
        for stop in stops:
            if not len(at):
                break
            first, last = band[i].start, band[stop - 1].stop
            items, others = _space("x", kind, stop - i, len(at)), _space("y", kind, last - first, len(at))
            np.take(lines[0][i:stop, part], p, axis=1, out=items, mode="clip")
            np.take(lines[1][first:last], q, axis=1, out=others, mode="clip")
            for item, columns in zip(items, band[i:stop]):
                _next_row(above, row, item, others[columns.start - first : columns.stop - first], columns, cost)
                above, row = row, above
            i = stop
            reached = above[columns.start + 1 : columns.stop + 1].min(axis=0) + rest[stop].ravel()[at] if stop < n else above[m]
            kept = np.flatnonzero(reached <= squares[part][p, q])
            at, p, q = at[kept], p[kept], q[kept]
            if stop < n:
                left = slice(columns.start, columns.stop + 2)
                held, above, row, cost = above[left][:, kept], *(x[:, : len(at)] for x in (above, row, cost))
                above[left] = held
        found.append((p + start, q))
    p, q = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, int),) * 2
    if short is not a:
        order = np.lexsort((p, q))
        p, q = q[order], p[order]
    return p, q


def lower_bounds(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Matrix of lower bounds of the distance of every row of ``a`` to every row of ``b``."""
    if a.shape[1] > b.shape[1]:
        return lower_bounds(b, a, radius).T
    highest = np.abs(a.max(axis=1)[:, None] - b.max(axis=1)[None, :])
    lowest = np.abs(a.min(axis=1)[:, None] - b.min(axis=1)[None, :])
    envelope = np.sqrt(_outside_envelope(a, b, radius))
    return np.maximum(np.maximum(highest, lowest), envelope)


def _straight(a: np.ndarray, b: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Which pairs of rows may be within the limits without warping, by one matrix product in single precision.

    Rows are taken from a common centre, and their squares are two more columns of the product. ``slack`` covers the
    rounding of all of it: of n + 2 products, whose sizes add up to twice the squares at most.
    """
    slack, centre = (a.shape[1] + 8) * 1.3e-7, b.mean(axis=0)
    a, b = a - centre, b - centre
    x, y = np.ones((len(a), a.shape[1] + 2), np.float32), np.ones((len(b), a.shape[1] + 2), np.float32)
    x[:, :-2], y[:, :-2] = a, -2 * b
    x[:, -2], y[:, -1] = ((v * v).sum(axis=1) * (1 - slack) for v in (a, b))
    with np.errstate(over="ignore"):
        wide = (limits * limits * (1 + 1e-6) + 1e-35).astype(np.float32)
    return x @ y.T <= wide[:, None]


def cheap_bounds(a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Lower bounds of the distances of all pairs of rows; without warping by one matrix product."""
    largest = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if radius or a.shape[1] != b.shape[1] or not largest < SINGLE_MAX:
        return lower_bounds(a, b, radius) * (1 - 1e-12)
    slack = (a.shape[1] + 8) * 1e-15
    squares = [(x * x).sum(axis=1) * (1 - slack) for x in (a, b)]
    return np.sqrt(np.maximum(squares[0][:, None] + squares[1][None, :] - 2 * (a @ b.T), 0.0) * (1 - slack))


def close_pairs(a, b, limits, radius, allowed=None):
    """Indices and distances of the pairs within the limit of their row of ``a``.

    Pairs that are surely too far are left out by cheaper means: without warping by a matrix product, else by
    bounds and distances in single precision, whose limits are widened by their largest error, in stages if they are many.
    The others are measured in double precision. Rows of ``a`` and ``b`` without any allowed partner are left out beforehand.
    """
    if allowed is not None:
        some = [np.flatnonzero(allowed.any(axis=axis)) for axis in (1, 0)]
        if not len(some[0]):
            return
        if allowed.size > len(some[0]) * len(some[1]):
            for i, j, distance in close_pairs(a[some[0]], b[some[1]], limits[some[0]], radius, allowed[np.ix_(*some)]):
                yield some[0][i], some[1][j], distance
            return
    length = a.shape[1] + b.shape[1]
    largest = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    single = bool(largest < SINGLE_MAX)  # also false where a value is no number
    if single and radius == 0 and a.shape[1] == b.shape[1]:
        maybe, single = _straight(a, b, limits), False
    elif single:
        # each item is off by 6e-8 of it, each sum and product by 6e-8 of the result
        wide = (limits + np.sqrt(length) * 1.3e-7 * largest) * (1 + (length + 8) * 1e-7)
        a_single, b_single = a.astype(np.float32), b.astype(np.float32)
        if len(a) * len(b) > FEW and not np.isinf(limits).all():
            rows, cols = _in_stages(a_single, b_single, wide * (1 + 1e-6), radius, allowed)
            yield from _measured(a, b, rows, cols, limits, radius)
            return
        maybe = lower_bounds(a_single, b_single, radius) <= wide[:, None]
    else:
        maybe = lower_bounds(a, b, radius) * (1 - 1e-12) <= limits[:, None]
    if allowed is not None:
        maybe &= allowed
    rows, cols = np.divmod(np.flatnonzero(maybe), maybe.shape[1])
    single = single and not np.isinf(limits).all()
    for start in range(0, len(rows) if single else 0, CANDIDATES_AT_ONCE):
        some = slice(start, start + CANDIDATES_AT_ONCE)
        near = dtw_rows(a_single[rows[some]], b_single[cols[some]], radius) <= wide[rows[some]]
        yield from _measured(a, b, rows[some][near], cols[some][near], limits, radius)
    if not single:
        yield from _measured(a, b, rows, cols, limits, radius)


def _measured(a, b, rows, cols, limits, radius):
    for start in range(0, len(rows), CANDIDATES_AT_ONCE):
        i, j = rows[start : start + CANDIDATES_AT_ONCE], cols[start : start + CANDIDATES_AT_ONCE]
        distance = dtw_rows(a[i], b[j], radius)
        near = distance <= limits[i]
        yield i[near], j[near], distance[near]
