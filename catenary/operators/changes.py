"""Applying a feed of inserts, updates and deletes to rebuild the current state (problem 5).

Method: column-wise last writer wins, in SQL. One grouping per key takes, for each field, max_by over the changes that set it,
and keeps it only if its sequence lies after the latest delete or replacement. Nothing is ordered or replayed, so repeated,
late and out-of-order changes need no care, and the whole fold is a partial aggregation: a key with a third of all changes is
one row per input partition before the shuffle.

Defined results:

* A null in a field means that the change does not set it; what was in force before stays in force.
* Of equal sequences the greatest value counts; a delete wins over anything of its own sequence.
* Changes without a key or a sequence belong to no place in the order and are left out.
* An empty feed gives an empty state. Extra columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def apply_changes(feed: DataFrame, keys: tuple[str, ...], sequence: str, fields: tuple[str, ...], deleted: str, replaces: str | None = None) -> DataFrame:
    """The live rows after all changes: keys, ``sequence`` (the highest one), ``<deleted>_at`` (of the last delete or null),
    then each field and ``<field>_at`` (the sequence of the change that set it).

    ``deleted`` is a SQL condition on a change that holds for deletes, is false for inserts and null for changes that say
    nothing of it; ``replaces`` one that holds for changes that set the whole row, so that older values end there too.
    A row is live if an insert lies after its last delete. Fields that nobody selects from the result are not even read.
    """
    key_list = ", ".join(map(_quoted, keys))
    seq = _quoted(sequence)
    asks = ", ".join(
        f"max(IF({_quoted(f)} IS NOT NULL, {seq}, NULL)) AS {_quoted(f + '_at')}, "
        f"max_by({_quoted(f)}, struct({seq}, {_quoted(f)})) FILTER (WHERE {_quoted(f)} IS NOT NULL) AS {_quoted(f)}"
        for f in fields
    )
    replaced = f", max({seq}) FILTER (WHERE {replaces}) AS __replaced" if replaces else ", CAST(NULL AS bigint) AS __replaced"
    after = "greatest(coalesce(__deleted + 1, {0}), coalesce(__replaced, {0}))"
    kept = ", ".join(f"IF({_quoted(f + '_at')} >= {after.format(_quoted(f + '_at'))}, {_quoted(g)}, NULL) AS {_quoted(g)}" for f in fields for g in (f, f + "_at"))
    return feed.sparkSession.sql(
        f"""
        SELECT {key_list}, {seq}, __deleted AS deleted_at{', ' + kept if fields else ''}
        FROM (
            SELECT {key_list}, max({seq}) AS {seq}, max({seq}) FILTER (WHERE {deleted}) AS __deleted,
                   max({seq}) FILTER (WHERE NOT ({deleted})) AS __inserted{replaced}{', ' + asks if fields else ''}
            FROM {{feed}}
            WHERE {seq} IS NOT NULL AND {' AND '.join(_quoted(k) + ' IS NOT NULL' for k in keys)}
            GROUP BY {key_list}
        )
        WHERE __inserted > coalesce(__deleted, __inserted - 1)
        """,
        feed=feed,
    )


def _feed(versions: DataFrame) -> DataFrame:
    return versions.select("source", clean("key").alias("key"), versions["revision"].cast("bigint").alias("revision"), "payload", "hash", "deleted", "metadata")


def live_records(versions: DataFrame) -> DataFrame:
    """The live records with the payload, hash and metadata in force: a payload is set as a whole and with it the hash; metadata is
    set by every version."""
    return apply_changes(_feed(versions), ("source", "key"), "revision", ("payload", "hash", "metadata"), "deleted")


def live_revisions(versions: DataFrame) -> DataFrame:
    """source, key, revision, payload_revision of the live records. Whether a version carries a payload is read from the payload
    itself, but only that is kept of it, so no payload is moved."""
    marks = _feed(versions).withColumn("payload", F.when(F.col("payload").isNotNull(), 1))
    return apply_changes(marks, ("source", "key"), "revision", ("payload",), "deleted").select("source", "key", "revision", F.col("payload_at").alias("payload_revision"))
