"""Sums over many rectangles against the points of one tile, in time n·log n, not rectangles times border points.

Whole numbers only (counts and decimals), so that a sum may be had as a difference and stays exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

# A decimal is summed as four numbers of 32 bits, each in a long of its own: 2^31 rows fit.
LIMBS, BITS, MASK = 4, 32, (1 << 32) - 1


def _limbs(column: pa.ChunkedArray) -> list[np.ndarray]:
    """Whole numbers whose weighted sum is the column; NULLs count as 0. The last list counts the rows with a value."""
    array = column.combine_chunks()
    array = array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array
    known = np.asarray(array.is_valid()).astype(np.int64)
    if pa.types.is_decimal(array.type):
        words = np.frombuffer(array.buffers()[1], dtype="<i8")[2 * array.offset :][: 2 * len(array)].reshape(-1, 2)
        low, high = words[:, 0] * known, words[:, 1] * known
        return [low & MASK, (low >> BITS) & MASK, high & MASK, high >> BITS, known]
    return [np.asarray(array.fill_null(0)).astype(np.int64), known]


def _decimals(limbs: np.ndarray, known: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Decimals out of their four summed limbs, NULL where no row had a value."""
    digits, carry = [], np.zeros(limbs.shape[1], dtype=np.int64)
    for limb in limbs:
        carry = carry + limb
        digits.append(carry & MASK)
        carry = carry >> BITS
    words = np.empty((limbs.shape[1], 2), dtype="<i8")
    words[:, 0], words[:, 1] = digits[0] | (digits[1] << BITS), digits[2] | (digits[3] << BITS)
    valid = pa.py_buffer(np.packbits(known > 0, bitorder="little").tobytes())
    return pa.Array.from_buffers(kind, len(words), [valid, pa.py_buffer(words.tobytes())])


def _corner_sums(rank: np.ndarray, weights: np.ndarray, first: list[np.ndarray], below: list[np.ndarray]) -> list[np.ndarray]:
    """Per pair of lists (i, k): the weights of the first i points whose rank is below k.

    The points are split by their rank's highest bit, each half keeping its order, then by
    the next one: a query follows one half and takes the other's running sum (a wavelet matrix).
    """
    lows = [np.zeros(len(i), dtype=np.int64) for i in first]
    highs = [np.array(i) for i in first]
    sums = [np.zeros((len(weights), len(i)), dtype=np.int64) for i in first]
    for bit in reversed(range(int(len(rank)).bit_length())):
        one = (rank >> bit) & 1 == 1
        zeros = np.concatenate([[0], np.cumsum(~one)])
        running = np.zeros((len(weights), len(rank) + 1), dtype=np.int64)
        np.cumsum(np.where(one, 0, weights), axis=1, out=running[:, 1:])
        for q, k in enumerate(below):
            right = (k >> bit) & 1 == 1
            low, high = lows[q], highs[q]
            sums[q][:, right] += running[:, high[right]] - running[:, low[right]]
            lows[q] = np.where(right, zeros[-1] + low - zeros[low], zeros[low])
            highs[q] = np.where(right, zeros[-1] + high - zeros[high], zeros[high])
        order = np.concatenate([np.flatnonzero(~one), np.flatnonzero(one)])
        rank, weights = rank[order], weights[:, order]
    return sums


def rectangle_sums(points: pa.Table, shapes: pa.Table, xy: tuple[str, str], bounds: tuple[str, ...], parts: list[str], strict: bool) -> pa.Table:
    """`bounds` of the shapes that hold a point, with the sum of every column of `parts` over the points inside."""
    x, y = (np.asarray(points[c].combine_chunks()) for c in xy)
    x1, y1, x2, y2 = (np.asarray(shapes[c].combine_chunks()) for c in bounds)
    by_y, by_x = np.argsort(y, kind="stable"), np.argsort(x, kind="stable")
    rank = np.empty(len(x), dtype=np.int64)
    rank[by_x] = np.arange(len(x))
    columns = [_limbs(points[p]) for p in parts]
    weights = np.stack([np.ones(len(x), dtype=np.int64), *[limb for c in columns for limb in c]])[:, by_y]
    # strict bounds leave out the points on them
    side = ("right", "left") if strict else ("left", "right")
    xs, ys = x[by_x], y[by_y]
    left, right = np.searchsorted(xs, x1, side[0]), np.searchsorted(xs, x2, side[1])
    low, high = np.searchsorted(ys, y1, side[0]), np.searchsorted(ys, y2, side[1])
    right, high = np.maximum(left, right), np.maximum(low, high)
    a, b, c, d = _corner_sums(rank[by_y], weights, [high, high, low, low], [right, left, right, left])
    found = a - b - c + d
    hit = found[0] > 0
    found = found[:, hit]
    out, at = {n: pa.array(v[hit]) for n, v in zip(bounds, (x1, y1, x2, y2))}, 1
    for name, column in zip(parts, columns):
        own, at = found[at : at + len(column)], at + len(column)
        kind = points.schema.field(name).type
        out[name] = _decimals(own[:LIMBS], own[-1], kind) if len(column) > 2 else pa.array(own[0], mask=own[-1] == 0)
    return pa.table(out)
