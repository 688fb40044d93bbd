"""The queries of the problems on training data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from .episodes import match_episodes
from .groups import linked_groups
from .languages import language_segments
from .leaks import leaked_items
from .tokens import encode_corpus


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    found = match_episodes(table(spark, folder, "episodes"))
    return found.select(F.least("a", "b").alias("episode_id_a"), F.greatest("a", "b").alias("episode_id_b"))


def p2_confidence(spark: SparkSession, folder: str) -> DataFrame:
    """The pairs of p2_found with their confidence."""
    found = match_episodes(table(spark, folder, "episodes"))
    return found.select(F.least("a", "b").alias("episode_id_a"), F.greatest("a", "b").alias("episode_id_b"), F.round("confidence", 4).alias("confidence"))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return linked_groups(table(spark, folder, "unit_pairs"))


def p6_ids(spark: SparkSession, folder: str) -> DataFrame:
    return encode_corpus(table(spark, folder, "documents"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return leaked_items(table(spark, folder, "documents"), table(spark, folder, "eval_items")).select("doc_id", "item_id")


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    tables = (table(spark, folder, name) for name in ("documents", "eval_items", "languages"))
    return language_segments(*tables, only_cases=True).select("doc_id", "segment_no", "lang")


QUERIES = {"p2_found": p2_found, "p2_confidence": p2_confidence, "p3_found": p3_found, "p6_ids": p6_ids, "p7_found": p7_found, "p8_found": p8_found}
SQL = {
    "p3_found": r"""
WITH RECURSIVE p AS (
  SELECT lower(regexp_replace(left_unit, '^\s+|\s+$', '', 'g')) AS l, lower(regexp_replace(right_unit, '^\s+|\s+$', '', 'g')) AS r FROM unit_pairs),
units AS (SELECT l AS unit FROM p WHERE l <> '' UNION SELECT r FROM p WHERE r <> ''),
edges AS (SELECT l AS a, r AS b FROM p WHERE l <> r UNION SELECT r, l FROM p WHERE l <> r),
reach AS (
  SELECT unit, unit AS other FROM units
  UNION
  SELECT reach.unit, edges.b FROM reach JOIN edges ON edges.a = reach.other)
SELECT unit, min(other) AS group_unit FROM reach GROUP BY unit
"""
}
