"""Aggregates that can be summed up in steps: rows -> cells -> blocks of cells -> shapes.

Every aggregate is kept as partial columns that merge by SUM, MIN or MAX, so that a
pre-aggregated grid cell and a single row have the same form and can be unioned.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, LongType


@dataclass(frozen=True)
class Agg:
    kind: str
    cols: tuple[str, ...] = ()
    scale: int | None = None  # decimal digits for exact, order-independent sums


def count(*cols: str) -> Agg:
    """Matches whose listed columns are all non-null; without columns, all matches."""
    return Agg("count", cols)


def total(col: str, scale: int | None = None) -> Agg:
    """SUM, NULL when nothing matches."""
    return Agg("sum", (col,), scale)


def mean(col: str, scale: int | None = None) -> Agg:
    return Agg("avg", (col,), scale)


def deviation(col: str, scale: int | None = None) -> Agg:
    """Sample standard deviation, NULL below two values."""
    return Agg("stddev", (col,), scale)


def lowest(col: str) -> Agg:
    return Agg("min", (col,))


def highest(col: str) -> Agg:
    return Agg("max", (col,))


def _value(col: str, scale: int | None) -> Column:
    return F.col(col).cast(f"decimal(18,{scale})") if scale is not None else F.col(col).cast("double")


class Partials:
    """The partial columns a set of named aggregates needs."""

    def __init__(self, aggs: dict[str, Agg]):
        self.aggs = aggs
        self.parts: list[tuple] = []
        for agg in aggs.values():
            for part in self._needed(agg):
                if part not in self.parts:
                    self.parts.append(part)

    @staticmethod
    def _needed(agg: Agg) -> list[tuple]:
        if agg.kind == "count":
            return [("count", agg.cols, None)]
        if agg.kind in ("min", "max"):
            return [(agg.kind, agg.cols, None)]
        if agg.kind == "stddev":
            return [("shifted", agg.cols, agg.scale), ("square", agg.cols, agg.scale), ("count", agg.cols, None)]
        needed = [("sum", agg.cols, agg.scale)]
        return [*needed, ("count", agg.cols, None)] if agg.kind == "avg" else needed

    @property
    def inputs(self) -> list[str]:
        return list(dict.fromkeys(c for a in self.aggs.values() for c in a.cols))

    @property
    def names(self) -> list[str]:
        return [f"p{i}" for i in range(len(self.parts))]

    @property
    def exact(self) -> bool:
        """Whether all partials are whole numbers or decimals that are summed up, so that sums may be subtracted."""
        return all(op == "count" or (op in ("sum", "shifted", "square") and scale is not None) for op, _, scale in self.parts)

    def _type(self, op: str, scale: int | None) -> str | None:
        if scale is None or op not in ("sum", "shifted", "square"):
            return None
        return f"decimal(38,{2 * scale if op == 'square' else scale})"

    @property
    def types(self) -> list[DataType]:
        """The types of exact partials, as they are summed up."""
        return [LongType() if op == "count" else DecimalType(38, 2 * scale if op == "square" else scale) for op, _, scale in self.parts]

    def _centre(self, df: DataFrame, col: str, scale: int | None) -> Column:
        """The middle of a column's finite values, as one value that deviations are measured from.

        Sums of squares lose all digits where values lie far from 0; taken from the middle of
        their range they don't. It depends on the values alone, so stored cells keep fitting.
        """
        v = _value(col, scale)
        known = v if scale is not None else F.when(F.abs(v) < F.lit(float("inf")), v)
        middle = F.min(known) + (F.max(known) - F.min(known)) / 2
        return F.coalesce(df.select(middle.alias("c").cast(self._type("sum", scale) or "double")).scalar(), F.lit(0))

    def of_rows(self, df: DataFrame) -> list[Column]:
        """Partial columns of one row of `df`; compute them before a join, not once per pair."""
        out = []
        for name, (op, cols, scale) in zip(self.names, self.parts):
            if op == "count":
                known = F.lit(True)
                for c in cols:
                    known = known & F.col(c).isNotNull()
                col = F.when(known, 1).otherwise(0).cast("long")
            elif op in ("min", "max"):
                col = F.col(cols[0])
            else:
                v = _value(cols[0], scale)
                if op in ("shifted", "square"):
                    v = v - self._centre(df, cols[0], scale)
                    v = v.cast(f"decimal(18,{scale})") if scale is not None else v
                col = v * v if op == "square" else v
            out.append(col.alias(name))
        return out

    def merged(self, when: Column | None = None, suffix: str = "") -> list[Column]:
        """Aggregate expressions that merge partial columns, optionally only where `when` holds."""
        out = []
        for name, (op, _, scale) in zip(self.names, self.parts):
            col = F.col(name) if when is None else F.when(when, F.col(name))
            if op in ("min", "max"):
                agg = F.min(col) if op == "min" else F.max(col)
            else:
                agg = F.sum(col)
                if self._type(op, scale):
                    agg = agg.cast(self._type(op, scale))
            out.append(agg.alias(name + suffix))
        return out

    def _part(self, op: str, agg: Agg, suffix: str) -> Column:
        scale = agg.scale if op in ("sum", "shifted", "square") else None
        return F.col(self.names[self.parts.index((op, agg.cols, scale))] + suffix)

    def final(self, name: str, suffix: str = "") -> Column:
        """The named aggregate out of merged partial columns."""
        agg = self.aggs[name]
        if agg.kind == "count":
            return F.coalesce(self._part("count", agg, suffix), F.lit(0).cast("long"))
        if agg.kind in ("min", "max"):
            return self._part(agg.kind, agg, suffix)
        if agg.kind == "sum":
            return self._part("sum", agg, suffix).cast("double")
        n = self._part("count", agg, suffix)
        if agg.kind == "avg":
            return F.try_divide(self._part("sum", agg, suffix).cast("double"), n)
        s = self._part("shifted", agg, suffix).cast("double")
        q = self._part("square", agg, suffix).cast("double")
        return F.when(n > 1, F.sqrt(F.greatest(q - s * s / F.nullif(n, F.lit(0)), F.lit(0.0)) / (n - 1)))


def merge_partials(df: DataFrame, keys: list[str], sums: dict[str, str]) -> DataFrame:
    """Add up partial results that arrived in batches: {output: partial column} per key."""
    return df.groupBy(*keys).agg(*[F.sum(src).alias(out) for out, src in sums.items()])
