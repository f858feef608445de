"""Global order and running values over groups of any size, without a task that holds a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

#: Positions of one block of `running_before`.
BLOCK = 1024
#: A key is cut once it has so many rows and over one in HOT_KEYS of all; so at most HOT_KEYS are cut.
HOT_ROWS, HOT_KEYS = 10_000, 1000


def in_order(df: DataFrame, keys: list[Column | str], label: str) -> DataFrame:
    """`df` range-partitioned and sorted by `keys` and stored, with `part` and `at`.

    `at` ascends by one within a range and ranges ascend by `part`. Rows that agree in all
    keys share a range, so keys that may repeat without bound need a last one that tells
    rows apart.
    """
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id()
    kept = stored(ranged.select("*", place.alias("at")), label)
    return kept.withColumn("part", F.shiftright("at", 33))


def part_starts(ordered: DataFrame, *group: str) -> DataFrame:
    """Per `part` (and group): first_at, rows, and `before`, the rows of the group in earlier parts.

    One row per part and group; a window holds as many rows as the group has parts.
    """
    spans = ordered.groupBy("part", *group).agg(F.min("at").alias("first_at"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return spans.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))


def running(ordered: DataFrame, sums: dict[str, str], *group: str) -> DataFrame:
    """`ordered` (of `in_order`, groups lying together) with sums over the group's rows ahead of each row.

    `sums` maps a new name to a column. Windows run inside one range and over one row per
    range of a group.
    """
    parts = ordered.groupBy("part", *group).agg(*[F.sum(c).alias(f"{n}_part") for n, c in sums.items()])
    earlier = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "part", *group, *[F.coalesce(F.sum(f"{n}_part").over(earlier), F.lit(0)).alias(f"{n}_ahead") for n in sums]
    )
    inside = Window.partitionBy("part", *group).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    own = ordered.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"{n}_own") for n, c in sums.items()])
    return own.join(parts, ["part", *group]).select(
        *ordered.columns, *[(F.col(f"{n}_ahead") + F.col(f"{n}_own")).alias(n) for n in sums]
    )


def split_join(
    rows: DataFrame, keyed: DataFrame, on: list[str], count: str, total: int, hot_rows: int | None = None
) -> DataFrame:
    """Inner join of `rows` with `keyed`, one row per key, which says in `count` how many rows have the key.

    `total` is the number of rows, or a bound above it. Keys of very many rows are cut into
    parts of about total / HOT_KEYS rows (`hot_rows` at least, by default HOT_ROWS); their list
    has at most total / `hot_rows` and never more than HOT_KEYS rows and is broadcast. Other
    keys are neither repeated nor salted.
    """
    most = max(hot_rows or HOT_ROWS, -(-total // HOT_KEYS))
    parts = F.ceil(F.col(count) / F.lit(most)).cast("int")
    hot = keyed.filter(F.col(count) > most).select(*on, parts.alias("hot_parts"))
    spread = keyed.withColumn("hot_part", F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1)))
    dealt = F.pmod(F.xxhash64(*rows.columns), F.coalesce("hot_parts", F.lit(1))).cast("int")
    salted = rows.join(F.broadcast(hot), on, "left").select(*rows.columns, dealt.alias("hot_part"))
    return salted.join(spread, [*on, "hot_part"]).drop("hot_part", count)


def running_before(df: DataFrame, group: str, position: str, folds: dict[str, tuple[str, str]]) -> DataFrame:
    """`df` with each fold over the group's rows of smaller `position`; nothing before gives 0.

    `folds` maps a new name to (`sum` or `bit_xor`, column). Positions of a group are distinct
    whole numbers. A window holds one block of positions, or one row per block of a group.
    """
    fold = {"sum": F.sum, "bit_xor": F.bit_xor}
    both = {"sum": lambda a, b: a + b, "bit_xor": lambda a, b: a.bitwiseXOR(b)}
    rows = df.withColumn("block", F.floor(F.col(position) / BLOCK))
    totals = rows.groupBy(group, "block").agg(*[fold[kind](c).alias(n) for n, (kind, c) in folds.items()])
    earlier = Window.partitionBy(group).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ahead = totals.select(
        group,
        "block",
        *[F.coalesce(fold[kind](n).over(earlier), F.lit(0)).alias(f"{n}_ahead") for n, (kind, _) in folds.items()],
    )
    inside = Window.partitionBy(group, "block").orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    own = rows.select(
        "*", *[F.coalesce(fold[kind](c).over(inside), F.lit(0)).alias(f"{n}_own") for n, (kind, c) in folds.items()]
    )
    return own.join(ahead, [group, "block"]).select(
        *df.columns, *[both[kind](F.col(f"{n}_ahead"), F.col(f"{n}_own")).alias(n) for n, (kind, _) in folds.items()]
    )
