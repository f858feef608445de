"""Disks against the rows of one tile: sums, ranks and nearest rows in time of a disk's strips, not of its rows.

Equal places are folded into one spot. The spots are cut into strips of y, about as many to
each, and these into columns of x: in a strip, a disk holds a run of whole columns, answered
from running sums, and a few columns at either end, whose spots are tested one by one. A
margin keeps rounding from taking a column as whole that is not, so all results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from siteplan.operators.tile_sums import LIMBS, _decimals, _limbs

# Spots of a cell, about; strips of positions and spots tested that are held at a time.
CELL_SPOTS, HELD = 2, 2**17
# Strips that positions are visited along at a time.
WALK_STRIPS = 8
# A disk of up to this many spots is searched for the nearest one by one; a larger one is narrowed first, in so many tries.
FEW, TRIES = 64, 40


def _numbers(table: pa.Table, name: str) -> np.ndarray:
    return np.asarray(table[name].combine_chunks())


def _runs(first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which run, number) of every number in the runs that start at `first`."""
    owner = np.repeat(np.arange(len(first)), length)
    return owner, np.arange(len(owner)) + np.repeat(first - (np.cumsum(length) - length), length)


def _chunks(lengths: np.ndarray, most: int) -> Iterator[slice]:
    """Slices whose lengths come to `most` at the utmost, unless a single one is longer."""
    ends, a = np.cumsum(lengths), 0
    while a < len(lengths):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, "right")))
        yield slice(a, b)
        a = b


def _add(total: np.ndarray, owner: np.ndarray, values: np.ndarray) -> None:
    """Add values to their owners' totals; owners ascend."""
    if len(owner):
        at = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        total[owner[at]] += np.add.reduceat(values, at, axis=0)


def _edges(sorted_values: np.ndarray, pieces: int) -> np.ndarray:
    """Values that cut the list into about `pieces` equal pieces, none of them empty."""
    edges = np.unique(sorted_values[np.arange(1, pieces) * len(sorted_values) // pieces])
    return edges[edges > sorted_values[0]]


class Tile:
    """The spots of a tile, by strip, column and x. `rows` lists the rows by spot, a spot's in the order of `rank`; `starts` their runs."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rank: np.ndarray | None = None):
        order = np.lexsort((y, x) if rank is None else (rank, y, x))
        x, y = x[order], y[order]
        new = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
        first = np.flatnonzero(new)
        x, y = x[first], y[first]
        pieces = max(1, int(np.sqrt(len(x) / CELL_SPOTS)))
        self.cuts = _edges(x, pieces)
        rims = _edges(np.sort(y), pieces)
        strip = np.searchsorted(rims, y, "right")
        by = np.argsort(strip, kind="stable")
        sizes = np.diff(np.append(first, len(order)))[by]
        self.starts = np.concatenate([[0], np.cumsum(sizes)])
        self.rows = order[_runs(first[by], sizes)[1]]
        self.x, self.y, strip = x[by], y[by], strip[by]
        self.columns = len(self.cuts) + 1
        cell = strip * self.columns + np.searchsorted(self.cuts, self.x, "right")
        self.cells = np.concatenate([[0], np.cumsum(np.bincount(cell, minlength=(len(rims) + 1) * self.columns))])
        at = np.flatnonzero(np.concatenate([[True], strip[1:] != strip[:-1]]))
        self.low, self.high = np.minimum.reduceat(self.y, at), np.maximum.reduceat(self.y, at)

    def walk(self, px: np.ndarray, py: np.ndarray) -> np.ndarray:
        """The order that leads from neighbour to neighbour, along x in a few strips at a time: what their disks read is in the cache."""
        return np.lexsort((px, np.searchsorted(self.low, py, "right") // WALK_STRIPS))

    def covers(self, px: np.ndarray, py: np.ndarray, r: np.ndarray) -> Iterator[tuple[slice, np.ndarray, list[np.ndarray]]]:
        """(positions, owner, [a, b, c, d]) by chunks of positions: per strip of a position's disk the spots b to c,
        which lie inside, and a to b and c to d, which may."""
        margin = r * 1e-9 + 1e-12
        first = np.searchsorted(self.high, py - r - margin, "left")
        number = np.maximum(np.searchsorted(self.low, py + r + margin, "right") - first, 0)
        for part in _chunks(number, HELD):
            owner, strip = _runs(first[part], number[part])
            ox, oy, far, near = (v[part][owner] for v in (px, py, r + margin, r - margin))
            low, high = self.low[strip] - oy, self.high[strip] - oy
            least, most = np.maximum(np.maximum(low, -high), 0), np.maximum(np.abs(low), np.abs(high))
            slack = (np.abs(ox) + far) * 2.0**-50
            out = far * far - least * least
            wide = np.sqrt(np.maximum(out, 0)) + slack
            sure = near * near - most * most
            deep = np.sqrt(np.maximum(sure, 0)) - slack
            base = strip * self.columns
            a = self.cells[base + np.searchsorted(self.cuts, ox - wide, "right")]
            d = self.cells[base + np.searchsorted(self.cuts, ox + wide, "right") + 1]
            d = np.where(out < 0, a, d)
            whole = (near > 0) & (sure > 0) & (deep > 0)
            left = np.searchsorted(self.cuts, ox - deep, "right") + 1
            right = np.maximum(np.searchsorted(self.cuts, ox + deep, "right"), left)
            b, c = (np.where(whole, self.cells[base + np.minimum(g, self.columns)], a) for g in (left, right))
            yield part, owner, [a, b, c, d]

    def near(
        self, px: np.ndarray, py: np.ndarray, r: np.ndarray, owner: np.ndarray, first: np.ndarray, end: np.ndarray
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(owner, spot, distance) of the spots first to end that lie within r, by chunks; owners ascend in each."""
        length = end - first
        for part in _chunks(length, HELD):
            run, spot = _runs(first[part], length[part])
            own = owner[part][run]
            dx, dy = px[own] - self.x[spot], py[own] - self.y[spot]
            distance = np.sqrt(dx * dx + dy * dy)
            hit = distance < r[own]
            yield own[hit], spot[hit], distance[hit]

    def sums(self, px: np.ndarray, py: np.ndarray, r: float, running: np.ndarray) -> np.ndarray:
        """Per position the sum over the rows within r. `running` holds the sums over the spots before each, by column."""
        total, reach = np.zeros((len(px), running.shape[1]), dtype=np.int64), np.full(len(px), r)
        for part, owner, (a, b, c, d) in self.covers(px, py, reach):
            own = total[part]
            _add(own, owner, running[c] - running[b])
            for first, end in ((a, b), (c, d)):
                for who, spot, _ in self.near(px[part], py[part], reach[part], owner, first, end):
                    _add(own, who, running[spot + 1] - running[spot])
        return total

    def nearest(self, px: np.ndarray, py: np.ndarray, r: float) -> tuple[np.ndarray, np.ndarray]:
        """(distance, spot) of the nearest spot within r, of equal ones that of the least x and y; infinite, −1 without one."""
        best, at = np.full(len(px), np.inf), np.full(len(px), -1)
        spread = max(self.x.max() - self.x.min(), self.y.max() - self.y.min())
        low, high = np.zeros(len(px)), np.full(len(px), r)
        reach = np.full(len(px), min(r, max(spread / np.sqrt(len(self.x)) * 2, r * 2.0**-20)))
        open_ = np.arange(len(px))
        for attempt in range(TRIES):
            if not len(open_):
                break
            if attempt == TRIES - 1:  # whatever is in reach
                reach[open_] = r
            x, y, now = px[open_], py[open_], reach[open_]
            held, found = np.zeros(len(x), dtype=np.int64), np.full(len(x), -1)
            for part, owner, (a, _, _, d) in self.covers(x, y, now):
                _add(held[part], owner, d - a)
                tight = high[open_][part] - low[open_][part] < now[part] * 1e-3
                test = (held[part] <= FEW) | tight | (attempt == TRIES - 1)
                use = test[owner]
                for who, spot, distance in self.near(x[part], y[part], now[part], owner[use], a[use], d[use]):
                    order = np.lexsort((self.y[spot], self.x[spot], distance, who))
                    who, spot, distance = who[order], spot[order], distance[order]
                    one = np.concatenate([[True], who[1:] != who[:-1]])[: len(who)]
                    who, spot, distance = who[one], spot[one], distance[one]
                    to = np.arange(len(x))[part][who]
                    mine, old = open_[to], found[to]
                    less = (old < 0) | (distance < best[mine])
                    same = (old >= 0) & (distance == best[mine])
                    less |= same & ((self.x[spot] < self.x[old]) | (self.x[spot] == self.x[old]) & (self.y[spot] < self.y[old]))
                    best[mine[less]], at[mine[less]], found[to[less]] = distance[less], spot[less], spot[less]
                held[part] = np.where(test, 0, held[part])
            crowded = held > 0
            done = ~crowded & ((found >= 0) | (now >= r))
            # too many: look nearer; none: look farther, at first in long steps
            full, none = open_[crowded], open_[~crowded & ~done]
            high[full] = reach[full]
            reach[full] = np.where(low[full] > 0, (low[full] + high[full]) / 2, high[full] / 3)
            low[none] = reach[none]
            high[none] = np.where(low[none] >= high[none], r, high[none])
            reach[none] = np.where(high[none] >= r, np.minimum(3 * low[none], r), (low[none] + high[none]) / 2)
            open_ = open_[~done]
        return best, at


def _finite(table: pa.Table) -> pa.Table:
    """The rows at finite places: from any other no distance is below a radius."""
    return table.filter(pa.array(np.isfinite(_numbers(table, "x")) & np.isfinite(_numbers(table, "y"))))


def _columns(rows: pa.Table, tile: Tile, parts: list[str]) -> tuple[np.ndarray, dict[str, list[int | None]]]:
    """Running sums over the spots, the number of rows first, and each part's columns among them (None: all zero)."""
    ones = np.ones(len(rows), dtype=np.int64)
    columns, of = [ones], {}
    for name in parts:
        of[name] = []
        for limb in _limbs(rows[name]):
            if (limb == 1).all():
                of[name].append(0)
            elif limb.any():
                of[name].append(len(columns))
                columns.append(limb)
            else:
                of[name].append(None)
    running = np.zeros((len(tile.x) + 1, len(columns)), dtype=np.int64)
    for i, column in enumerate(columns):
        running[:, i] = np.concatenate([[0], np.cumsum(column[tile.rows])])[tile.starts]
    return running, of


def disk_sums(spots: pa.Table, rows: pa.Table, radii: tuple[float, ...], parts: list[str], kinds: list[pa.DataType], least: bool) -> pa.Table:
    """x and y of the spots with a row within the last radius, every part summed within every radius (p_i), and the least distance (d)."""
    names = ["x", "y", *[f"{p}_{i}" for i in range(len(radii)) for p in parts], *(["d"] if least else [])]
    types = [pa.float64(), pa.float64(), *[k for _ in radii for k in kinds], *([pa.float64()] if least else [])]
    schema = pa.schema(list(zip(names, types)))
    spots, rows = _finite(spots), _finite(rows)
    if not len(spots) or not len(rows):
        return schema.empty_table()
    tile = Tile(_numbers(rows, "x"), _numbers(rows, "y"))
    running, of = _columns(rows, tile, parts)
    px, py = _numbers(spots, "x"), _numbers(spots, "y")
    at = tile.walk(px, py)
    px, py = px[at], py[at]
    found = [tile.sums(px, py, r, running) for r in radii]
    hit = found[-1][:, 0] > 0
    out = [pa.array(px[hit]), pa.array(py[hit])]
    for total in found:
        total = total[hit]
        for name, kind in zip(parts, kinds):
            limbs = [np.zeros(len(total), dtype=np.int64) if i is None else np.ascontiguousarray(total[:, i]) for i in of[name]]
            whole = len(limbs) > 2
            out.append(_decimals(np.stack(limbs[:LIMBS]), limbs[-1], kind) if whole else pa.array(limbs[0], mask=limbs[-1] == 0))
    if least:
        out.append(pa.array(tile.nearest(px[hit], py[hit], radii[-1])[0]))
    return pa.Table.from_arrays(out, schema=schema)


def ordered(values: pa.ChunkedArray) -> np.ndarray:
    """How many of the values come before each, NULL first and NaN last."""
    array = values.combine_chunks()
    array = array.combine_chunks() if isinstance(array, pa.ChunkedArray) else array
    known = np.asarray(array.is_valid())
    if pa.types.is_floating(array.type):
        given = np.asarray(array.filter(array.is_valid()))
        rank = np.searchsorted(np.sort(given), given, "left")
    else:
        rank = np.asarray(pc.rank(array.filter(array.is_valid()), tiebreaker="min")).astype(np.int64) - 1
    out = np.zeros(len(array), dtype=np.int64)
    out[known] = rank + (~known).sum()
    return out


def nearest_values(spots: pa.Table, rows: pa.Table, r: float, kind: pa.DataType) -> pa.Table:
    """The spots with a row within r: x, y, its distance, place and value v; of equal places the least value."""
    schema = pa.schema([*[(n, pa.float64()) for n in ("x", "y", "dist", "nb_x", "nb_y")], ("v", kind)])
    spots, rows = _finite(spots), _finite(rows)
    if not len(spots) or not len(rows):
        return schema.empty_table()
    tile = Tile(_numbers(rows, "x"), _numbers(rows, "y"), ordered(rows["v"]))
    px, py = _numbers(spots, "x"), _numbers(spots, "y")
    order = tile.walk(px, py)
    px, py = px[order], py[order]
    best, at = tile.nearest(px, py, r)
    hit = at >= 0
    at = at[hit]
    value = rows["v"].combine_chunks().take(pa.array(tile.rows[tile.starts[at]]))
    value = value.combine_chunks() if isinstance(value, pa.ChunkedArray) else value
    return pa.Table.from_arrays([pa.array(v) for v in (px[hit], py[hit], best[hit], tile.x[at], tile.y[at])] + [value.cast(kind)], schema=schema)


class Ranks:
    """How many of the ranks first to end lie below a given one: a wavelet matrix, one step per bit."""

    def __init__(self, rank: np.ndarray):
        self.bits = []
        for bit in reversed(range(int(len(rank)).bit_length())):
            one = (rank >> bit) & 1 == 1
            zeros = np.concatenate([[0], np.cumsum(~one, dtype=np.int32)])
            self.bits.append((bit, zeros.astype(np.int32)))
            rank = np.concatenate([rank[~one], rank[one]])

    def below(self, first: np.ndarray, end: np.ndarray, key: np.ndarray) -> np.ndarray:
        found = np.zeros(len(first), dtype=np.int64)
        for bit, zeros in self.bits:
            right = (key >> bit) & 1 == 1
            a, b = zeros[first].astype(np.int64), zeros[end].astype(np.int64)
            found += np.where(right, b - a, 0)
            first, end = np.where(right, zeros[-1] + first - a, a), np.where(right, zeros[-1] + end - b, b)
        return found


def disk_ranks(spots: pa.Table, rows: pa.Table, radii: tuple[float, ...]) -> pa.Table:
    """x and y of the spots with a row within the last radius, and within every radius the rows (n_i) and those whose v lies before v0 (less_i)."""
    counts = [f"{c}_{i}" for i in range(len(radii)) for c in ("n", "less")]
    schema = pa.schema([("x", pa.float64()), ("y", pa.float64()), *[(c, pa.int64()) for c in counts]])
    spots, rows = _finite(spots), _finite(rows)
    if not len(spots) or not len(rows):
        return schema.empty_table()
    # a stable order of the rows' values, and how many of them come before each spot's value
    both = ordered(pa.chunked_array([*rows["v"].chunks, *spots["v0"].chunks], rows["v"].type))
    value, asked = both[: len(rows)], both[len(rows) :]
    order = np.argsort(value, kind="stable")
    key = np.searchsorted(value[order], asked, "left")
    rank = np.empty(len(rows), dtype=np.int64)
    rank[order] = np.arange(len(rows))
    tile = Tile(_numbers(rows, "x"), _numbers(rows, "y"), rank)
    rank = rank[tile.rows]
    ranks, starts = Ranks(rank), tile.starts
    px, py = _numbers(spots, "x"), _numbers(spots, "y")
    at = tile.walk(px, py)
    px, py, key = px[at], py[at], key[at]
    out = []
    for r in radii:
        total, reach = np.zeros((len(px), 2), dtype=np.int64), np.full(len(px), r)
        for part, owner, (a, b, c, d) in tile.covers(px, py, reach):
            own, mine = total[part], key[part]
            run = np.flatnonzero(c > b)
            first, end = starts[b[run]], starts[c[run]]
            _add(own, owner[run], np.stack([end - first, ranks.below(first, end, mine[owner[run]])], axis=1))
            for low, high in ((a, b), (c, d)):
                for who, spot, _ in tile.near(px[part], py[part], reach[part], owner, low, high):
                    first, end = starts[spot], starts[spot + 1]
                    less = (rank[first] < mine[who]).astype(np.int64)
                    many = np.flatnonzero(end - first > 1)
                    less[many] = ranks.below(first[many], end[many], mine[who[many]])
                    _add(own, who, np.stack([end - first, less], axis=1))
        out.append(total)
    hit = out[-1][:, 0] > 0
    columns = [pa.array(px[hit]), pa.array(py[hit]), *[pa.array(np.ascontiguousarray(t[hit, i])) for t in out for i in (0, 1)]]
    return pa.Table.from_arrays(columns, schema=schema)
