"""The site-planning inputs derived from the given tables.

Each text is plain SQL that Spark and other engines read alike; a later view may name an
earlier one. Literals such as 1e2 are DOUBLE everywhere, 100.0 would be DECIMAL.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()

VIEWS = {
    "cells": """
        SELECT CASE l_returnflag WHEN 'N' THEN 'LTE' WHEN 'R' THEN 'GSM' ELSE 'UMTS' END AS radio,
               CAST(306 + l_suppkey % 14 AS STRING) AS mcc,
               CAST(l_orderkey * 8 + l_linenumber AS INT) AS cell,
               -125 + (((l_orderkey - l_orderkey % 32) * 7919) % 5400) / 1e2 + l_linenumber / 1e3 AS lon,
               33 + (((l_orderkey - l_orderkey % 32) * 104729) % 900) / 1e2 + l_linenumber / 1e3 AS lat
        FROM lineitem""",
    "towers": """
        SELECT CAST(FLOOR(cell / 256e0) AS BIGINT) AS bsid, ROUND(AVG(lon), 6) AS lon, ROUND(AVG(lat), 6) AS lat
        FROM cells
        WHERE radio = 'LTE' AND mcc IN ('310', '311', '312', '313', '314', '315', '316')
        GROUP BY CAST(FLOOR(cell / 256e0) AS BIGINT)""",
    "places": """
        SELECT lon1, lat1, lon1 + 5e-1 + ((c_custkey * 31) % 950) / 1e2 AS lon2,
               lat1 + 5e-1 + ((c_custkey * 17) % 150) / 1e2 AS lat2
        FROM (SELECT c_custkey, -125 + ((c_custkey * 7919) % 4400) / 1e2 AS lon1,
                     33 + ((c_custkey * 104729) % 700) / 1e2 AS lat1 FROM customer) q""",
    "pop": """
        SELECT -125 + ((o_orderkey * 104729) % 540000) / 1e4 AS lon,
               33 + ((o_orderkey * 7919) % 90000) / 1e4 AS lat,
               o_totalprice / 1e3 AS pop_cnt
        FROM orders""",
    "buildings": """
        SELECT -125 + ((l_orderkey * 7919 + l_linenumber * 31) % 54000) / 1e3 AS center_longitude,
               33 + ((l_orderkey * 104729 + l_partkey) % 9000) / 1e3 AS center_latitude,
               CASE WHEN l_linenumber = 7 THEN 0e0 ELSE l_extendedprice * 6e0 END AS area
        FROM lineitem""",
    "elev": """
        SELECT -125 + ((event_id * 7919) % 54000) / 1e3 AS longitude,
               33 + ((event_id * 104729) % 9000) / 1e3 AS latitude,
               CASE WHEN event_id % 13 = 0 THEN CAST('NaN' AS DOUBLE) ELSE value * 1e1 END AS elevation
        FROM events""",
    "elev_clean": """
        SELECT longitude, latitude, elevation FROM elev WHERE NOT isnan(elevation) AND elevation IS NOT NULL""",
    "points": """
        SELECT -125 + (k % 1350) * 4e-2 AS lon, 33 + ((k - k % 1350) / 135e1) * 4e-2 AS lat
        FROM (SELECT (p_partkey * 7919) % 303750 AS k FROM part) q""",
    "features": """
        SELECT event_id, %s FROM events"""
    % ", ".join(
        f"((event_id * {p}) % 1000) / 1e1 AS f{i}"
        for i, p in enumerate((101, 103, 107, 109, 113, 127, 131, 137, 139, 149, 151), 1)
    ),
}


def _names_in(text: str, known) -> list[str]:
    words = set(re.findall(r"[a-z_]\w*", text))
    return [n for n in known if n in words]


def views_needed(text: str) -> list[str]:
    """The derived views a query text needs, each after those it is made from."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for other in _from_names(VIEWS[name]):
                visit(other)
            order.append(name)

    for name in _from_names(text):
        visit(name)
    return order


def _from_names(text: str) -> list[str]:
    """Derived views named after FROM or JOIN or a comma that follows them."""
    found = re.findall(r"(?:FROM|JOIN)\s+([a-z_]\w*)", text)
    return [n for n in dict.fromkeys(found) if n in VIEWS]


def oracle(text: str) -> str:
    """The query text with its derived views in front, ready for a plain SQL engine."""
    needed = views_needed(text)
    if not needed:
        return text
    head = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in needed)
    body = text.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view as a DataFrame over the tables in `sf_dir`."""
    text = VIEWS[name]
    sources = {}
    for word in dict.fromkeys(re.findall(r"FROM\s+([a-z_]\w*)", text)):
        sources[word] = view(spark, sf_dir, word) if word in VIEWS else table(spark, sf_dir, word)
    for word in sources:
        text = re.sub(rf"FROM\s+{word}\b", f"FROM {{{word}}}", text)
    return spark.sql(text, **sources)
