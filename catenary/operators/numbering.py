"""Dense numbers over a whole table in a given order, without gathering it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import Cut


def numbered(rows: DataFrame, order: tuple[str, ...], name: str = "number") -> DataFrame:
    """rows with their place (from 0) in the order: a range sort, and the ranges' sizes added up. Only one count for each range
    comes to the driver."""
    at = F.monotonically_increasing_id()
    placed = Cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__id", at), "numbered").df
    placed = placed.withColumn("__part", F.shiftright("__id", 33)).withColumn("__place", F.col("__id").bitwiseAND((1 << 33) - 1))
    sizes = sorted((r[0], r[1]) for r in placed.groupBy("__part").count().collect())
    base, offsets = 0, {}
    for part, size in sizes:
        offsets[part] = base
        base += size
    if not offsets:
        return placed.drop("__id", "__part", "__place").withColumn(name, F.lit(None).cast("bigint"))
    table = F.create_map([F.lit(x).cast("bigint") for pair in offsets.items() for x in pair])
    return placed.withColumn(name, table[F.col("__part")] + F.col("__place")).drop("__id", "__part", "__place")
