"""Joining computed columns back to the rows they belong to."""

from __future__ import annotations

from pyspark.sql import DataFrame


def attach(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on the keys; the keys appear once, in front.

    Left rows may repeat a key (copies of one place); Spark's adaptive skew join splits
    such a key, as inner and left joins allow splitting the left side.
    """
    if how not in ("inner", "left"):
        raise ValueError("attach joins are inner or left")
    return left.join(right, list(on), how)
