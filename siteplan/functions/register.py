"""The column functions as SQL functions of the session."""

from __future__ import annotations

from pyspark.sql import SparkSession

from siteplan.functions.geo import LAT_DEGREE_MILES, LON_DEGREE_MILES
from siteplan.functions.scoring import DECAY_K, SCORE_M, SCORE_Q


def register_functions(spark: SparkSession) -> list[str]:
    """Create dist, rect_area, point_score, inverse_square and decay_penalty; plain SQL bodies Catalyst inlines."""
    miles = ", ".join(f"{k}, {v}e0" for k, v in LON_DEGREE_MILES.items())
    rect = "lon1 DOUBLE, lat1 DOUBLE, lon2 DOUBLE, lat2 DOUBLE"
    bodies = {
        "dist": (rect, "sqrt((lon1 - lon2) * (lon1 - lon2) + (lat1 - lat2) * (lat1 - lat2))"),
        "rect_area": (
            rect,
            f"abs(lon1 - lon2) * try_element_at(map({miles}), abs(cast((lat1 - lat2) / 2e0 + lat2 AS INT)))"
            f" * abs(lat1 - lat2) * {LAT_DEGREE_MILES}",
        ),
        "point_score": (
            "n BIGINT, d DOUBLE",
            f"CASE WHEN d IS NULL THEN 0e0 ELSE 1 / (2 + {SCORE_M} * d) END"
            f" + 0.5e0 * (1 - try_divide(1e0, pow(log({SCORE_Q}e0, coalesce(n, 0) + {SCORE_Q}e0), 2)))",
        ),
        "inverse_square": ("d DOUBLE", "try_divide(1e0, d * d)"),
        "decay_penalty": ("d DOUBLE", f"{DECAY_K:.6e} / (d * d + {DECAY_K:.6e})"),
    }
    for name, (args, body) in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS DOUBLE RETURN {body}")
    return list(bodies)
