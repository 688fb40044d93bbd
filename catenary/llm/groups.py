"""Consolidating pairwise matches into groups (problem 3).

Method: random contraction. Units get numbers; in each round every vertex hooks to that one of itself and its neighbours which
comes first in a fresh hash order, edges are relabelled to the chosen vertices, loops and repeats are dropped, and the rounds
go on until no edge is left. As at least a constant share of the vertices is expected to vanish in a round whatever the shape,
the number of rounds is logarithmic and the work of all rounds together is a small multiple of the first. The chosen vertices
of all rounds are then expanded backwards, from the last round to the first, and each unit gets the smallest unit of its group. The
contraction is the core's ``components``.

Every round reads and writes tables in the shared folder, so a lost executor costs a few tasks. No vertex's neighbours are
gathered: the choice is a partial aggregation, and relabelling goes through ``lookup``, which keeps hot vertices in place.

Defined results:

* A unit paired only with itself or with null is a group of its own. A null, or a text that is empty after trimming, is no unit.
* Repeated and reversed pairs change nothing. No pairs give no rows. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean
from ..operators.components import components, contract
from ..operators.lookup import ROWS

__all__ = ["contract", "linked_groups"]


def linked_groups(pairs: DataFrame, left: str = "left_unit", right: str = "right_unit", hot_rows: int = ROWS) -> DataFrame:
    """unit, group_unit for each unit on either side of any pair; ``group_unit`` is the smallest unit of the group."""
    sides = pairs.select(F.nullif(clean(left), F.lit("")).alias("l"), F.nullif(clean(right), F.lit("")).alias("r"))
    return components(sides, "l", "r", hot_rows).select(F.col("node").alias("unit"), F.col("root").alias("group_unit"))
