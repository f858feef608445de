"""Centroids and areas of many rings at once, for tasks that hold them as Arrow arrays.

The formulas are those of `geo.ring_centroid` and `geo.ring_area_3395`, which work on one ring of a
column expression; here a step is taken for all vertices of a batch together.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from siteplan.functions.geo import WGS84_A, WGS84_E2


class Rings:
    """The vertices of a batch of rings; `size` is 0 for a NULL or empty ring."""

    def __init__(self, rings: pa.Array):
        points = rings.flatten()  # leaves out what NULL rings may cover
        numbers = points.flatten()
        self.size = np.asarray(pc.fill_null(pc.list_value_length(rings), 0)).astype(np.int64)
        width = np.asarray(pc.fill_null(pc.list_value_length(points), -1)).astype(np.int64)
        if ((width == 0) | (width == 1)).any():
            raise ValueError("a vertex has less than two coordinates")
        held = np.maximum(width, 0)
        at = np.cumsum(held) - held
        value = np.append(np.asarray(pc.fill_null(numbers, 0.0), dtype=np.float64), [0.0, 0.0])
        given = np.append(np.asarray(numbers.is_valid()), [False, False])
        self.x, self.y = value[at], value[at + 1]
        self.has_x, self.has_y = (width > 0) & given[at], (width > 0) & given[at + 1]
        self.full = np.flatnonzero(self.size)
        self.first = (np.cumsum(self.size) - self.size)[self.full]
        self.next = np.arange(1, len(width) + 1)
        self.next[self.first + self.size[self.full] - 1] = self.first

    def _moved(self, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, ...]:
        """Vertices relative to their ring's first one, to keep the products small, and those that follow them."""
        own = np.repeat(self.first, self.size[self.full])
        x, y = x - x[own], y - y[own]
        return x, y, x[self.next], y[self.next]

    def _sums(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.first) if len(self.first) else np.empty(0)

    def _all(self, known: np.ndarray) -> np.ndarray:
        return np.logical_and.reduceat(known, self.first) if len(self.first) else np.empty(0, bool)

    def _spread(self, values: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values of the full rings at the places of all rings."""
        out, has = np.zeros(len(self.size)), np.zeros(len(self.size), bool)
        out[self.full], has[self.full] = values, known
        return out, has

    def centroids(self) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """(values, known) of x and of y; a ring without area has its outline's centroid, an unknown coordinate leads to the first vertex."""
        with np.errstate(all="ignore"):
            ax, ay, bx, by = self._moved(self.x, self.y)
            cross = ax * by - bx * ay
            length = np.sqrt((bx - ax) * (bx - ax) + (by - ay) * (by - ay))
            known = self._all(self.has_x & self.has_y)
            area, outline = self._sums(cross), self._sums(length)
            found = []
            for a, b, start, has in ((ax, bx, self.x, self.has_x), (ay, by, self.y, self.has_y)):
                inside, along = self._sums((a + b) * cross) / (area * 3.0), self._sums((a + b) * length) / (outline * 2.0)
                moved = np.where(area != 0.0, inside, np.where(outline != 0.0, along, 0.0))
                found.append(self._spread(start[self.first] + np.where(known, moved, 0.0), has[self.first]))
        return found[0], found[1]

    def areas_3395(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, known) of the areas in square metres on the EPSG:3395 map; only `wanted` rings are computed."""
        e = WGS84_E2**0.5
        used = np.flatnonzero(np.repeat(wanted[self.full], self.size[self.full]))
        x, y, known = np.zeros(len(self.x)), np.zeros(len(self.x)), np.zeros(len(self.x), bool)
        with np.errstate(all="ignore"):
            phi = np.radians(self.y[used])
            sin = e * np.sin(phi)
            scaled = np.tan(0.7853981633974483 + phi / 2.0) * np.power((1.0 - sin) / (1.0 + sin), e / 2.0)
            x[used], y[used] = np.radians(self.x[used]) * WGS84_A, WGS84_A * np.log(scaled)
            # beyond the poles there is no such place
            known[used] = self.has_x[used] & self.has_y[used] & ~(scaled <= 0.0)
            y[~known] = 0.0
            ax, ay, bx, by = self._moved(x, y)
            doubled = self._sums(ax * by - bx * ay)
        return self._spread(np.abs(doubled) / 2.0, self._all(known))
