"""Reading antenna records, points, building outlines and CSV folders."""

from __future__ import annotations

import csv

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siteplan.schemas import CELLS_RAW, GEOJSON
from siteplan.session import kept


def read_cells_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=CELLS_RAW)


def read_points_csv(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Point CSVs with a header; types are inferred (one more pass) unless a schema is given."""
    if schema is not None:
        return spark.read.csv(path, header=True, schema=schema)
    return spark.read.csv(path, header=True, inferSchema=True)


def read_geojson(spark: SparkSession, path: str, keep_properties: bool = False) -> DataFrame:
    """One feature per line as (coordinates, type); coordinates stay JSON text."""
    features = spark.read.schema(GEOJSON).json(path)
    columns = ["geometry.coordinates", "geometry.type"] + (["properties"] if keep_properties else [])
    return features.select(*columns)


# Types a column without a schema is tried as, and what a text of the type looks like where
# the cast alone accepts more.
TRIED = {
    "int": r"^[+-]?[0-9]+$",
    "bigint": r"^[+-]?[0-9]+$",
    "double": r"[0-9]|nan|inf",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T]",
    "boolean": r"^(true|false)$",
}


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def read_csv_folder(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """All CSVs of a folder, columns matched by name even where files order them differently.

    The lines are read once as text and meet their file's header in a join by file name; the
    driver gets the distinct header lines, never the list of files. A file's first line that
    is not blank is its header. Columns a file lacks are NULL, columns without a name in
    `schema` are left out; without a schema, types are inferred from all values in one more
    pass. A value may not hold a line break.
    """
    read = spark.read.option("pathGlobFilter", "*.csv").text(path)
    lines = read.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("at"),
    )
    filled = lines.where(F.trim("value") != "")
    first = F.min(F.when(F.col("start") == 0, F.struct("at", "value"))).alias("first")
    heads = kept(filled.groupBy("file").agg(first).select("file", F.col("first.at").alias("head_at"), F.col("first.value").alias("head")), "heads")
    known = [r["head"] for r in heads.select("head").distinct().orderBy("head").collect()]
    if not known:
        raise ValueError(f"no CSV file with a header in {path}")
    columns = {head: next(csv.reader([head.removeprefix("\ufeff")])) for head in known}
    types = {f.name: f.dataType.simpleString() for f in schema} if schema else {}
    names = list(dict.fromkeys(c for head in known for c in columns[head] if not schema or c in types))

    rows = filled.join(heads, "file").where(F.col("at") != F.col("head_at"))
    parsed = []
    for head in known:
        ddl = ", ".join(f"{_quoted(c)} {types.get(c, 'string')}" for c in columns[head])
        parsed.append(F.when(F.col("head") == head, F.from_csv("value", ddl)))
    rows = rows.select(*[p.alias(f"p{i}") for i, p in enumerate(parsed)])
    each = [
        F.coalesce(*[F.col(f"p{i}")[c] for i, head in enumerate(known) if c in columns[head]]).alias(c) for c in names
    ]
    table = rows.select(*each)
    return table if schema else _typed(table)


def _typed(table: DataFrame) -> DataFrame:
    """String columns as the first of TRIED that all their values fit."""
    fits = []
    for i, c in enumerate(table.columns):
        v = F.col(_quoted(c))
        for kind, look in TRIED.items():
            fit = v.isNull() | (F.lower(v).rlike(look) & v.try_cast(kind).isNotNull())
            fits.append(F.bool_and(fit).alias(f"{kind}_{i}"))
    found = table.agg(*fits, *[F.count(F.col(_quoted(c))).alias(f"n_{i}") for i, c in enumerate(table.columns)]).first()
    out = []
    for i, c in enumerate(table.columns):
        kind = next((k for k in TRIED if found[f"{k}_{i}"] and found[f"n_{i}"]), "string")
        out.append(F.col(_quoted(c)).try_cast(kind).alias(c))
    return table.select(*out)
