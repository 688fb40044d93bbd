"""Joining with a table of one row per key where the other side's keys may be very unequal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot if it has more rows than this and than one in SHARE of all rows.
ROWS, SHARE = 1_000_000, 500


def lookup(left: DataFrame, right: DataFrame, key: str, rows: int, how: str = "inner", hot_rows: int = ROWS) -> DataFrame:
    """left joined with right, which has at most one row per key. ``rows``: how many rows left has.

    With at most ``hot_rows`` rows no key can be hot and one join is made. Otherwise the hot keys are counted: each holds more than
    1/SHARE of the rows, so there are fewer than SHARE of them whatever the size, and their rows of ``right`` are broadcast, so
    that hot rows of ``left`` stay where they are; the others are joined by a shuffle.
    """
    if rows <= hot_rows:
        return left.join(right, key, how)
    hot = [r[0] for r in left.groupBy(key).count().where(F.col("count") > max(hot_rows, rows // SHARE)).select(key).collect()]
    if not hot:
        return left.join(right, key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    return left.where(~is_hot).join(right, key, how).unionByName(left.where(is_hot).join(F.broadcast(right.where(F.col(key).isin(hot))), key, how))
