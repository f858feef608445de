"""Site score formulas as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the score, its list of neighbours and the pick penalty.
SCORE_M = 47
SCORE_Q = 40
DECAY_K = 0.000016


def point_score(n, d, m: float = SCORE_M, q: float = SCORE_Q) -> Column:
    """Closeness of the nearest tower plus half the saturation of the tower count."""
    n = F.col(n) if isinstance(n, str) else n
    d = F.col(d) if isinstance(d, str) else d
    level = F.log(float(q), F.coalesce(n, F.lit(0)).cast("double") + float(q))
    crowd = (1.0 - F.try_divide(F.lit(1.0), level * level)) * 0.5
    near = F.when(d.isNull(), F.lit(0.0)).otherwise(F.try_divide(F.lit(1.0), d * float(m) + 2.0))
    return near + crowd


def inverse_square(distance) -> Column:
    """1/d², NULL at distance zero."""
    d = F.col(distance) if isinstance(distance, str) else distance
    return F.try_divide(F.lit(1.0), d * d)


def decay_penalty(distance, k: float = DECAY_K) -> Column:
    """What a pick takes away from the score of a site at this distance; 1 at distance zero."""
    d = F.col(distance) if isinstance(distance, str) else distance
    return F.lit(k) / (d * d + F.lit(k))
