"""Queries that run streams over all of a table and give what they wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean, sha256_of
from ..session import shared_dir
from ..sources.tables import table
from ..streaming import feeds as S


#: Parts that a table is fed in, one micro-batch each, and by how many seconds a row may come late.
PARTS, LATE = 4, 1800


def _fed(s: SparkSession, rows: DataFrame, order, name: str, last: DataFrame | None = None) -> DataFrame:
    """A stream of all rows in parts, in order of a number (``order``), each part a micro-batch of its own; ``last`` comes after all."""
    at = f"{shared_dir(s)}/catenary-feed-{name}-{uuid.uuid4().hex}"
    low, high = rows.agg(F.min(order), F.max(order)).first()
    place = F.least(F.lit(PARTS - 1), F.floor((order - F.lit(low or 0)) * PARTS / F.lit(max(1, (high or 0) - (low or 0)))))
    for part in range(PARTS):  # the file source takes files in the order in which they were written
        rows.where(place == part).coalesce(1).write.mode("append").parquet(at)
    if last is not None:
        last.select(*rows.columns).coalesce(1).write.mode("append").parquet(at)
    return S.stream_table(s, at, files=1)


def _written(s: SparkSession, rows: DataFrame, mode: str = "append") -> DataFrame:
    at = f"{shared_dir(s)}/catenary-stream-{uuid.uuid4().hex}"
    S.run_to_end(rows, f"{at}/out", f"{at}/checkpoint", mode)
    return s.read.schema(rows.schema).option("recursiveFileLookup", "true").parquet(f"{at}/out")


def _timed_events(s: SparkSession, d: str) -> DataFrame:
    """Events out of order: each comes up to half an hour late; a beat after all of them lets the last windows end."""
    e = table(s, d, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    arrives = F.unix_timestamp("ts") + F.pmod(F.xxhash64("event_id"), F.lit(LATE))
    beat = e.agg((F.max("ts") + F.expr("INTERVAL 30 DAYS")).alias("ts")).where("ts IS NOT NULL").select(F.lit(None).cast("bigint").alias("event_id"), F.lit(None).cast("bigint").alias("user_id"), F.lit(None).cast("string").alias("event_type"), "ts")
    return _fed(s, e, arrives, "events", beat)


def stream_windows(s, d):
    """Counts by day and type, each window written once, when the watermark has passed it."""
    rows = S.windowed_counts(_timed_events(s, d), F.col("ts"), "1 day", "1 hour", "event_type")
    return _written(s, rows).where("event_type IS NOT NULL").select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n")


def stream_sliding(s, d):
    rows = S.sliding_counts(_timed_events(s, d).withColumn("real", F.col("event_id").isNotNull()), F.col("ts"), "2 days", "1 day", "1 hour", "real")
    return _written(s, rows).where("real").select(F.date_format("start", "yyyy-MM-dd").alias("day"), "n")


def stream_sessions(s, d):
    """Sessions of each user: events at most a day apart."""
    rows = S.session_counts(_timed_events(s, d), F.col("ts"), "1 day", "1 hour", "user_id")
    return _written(s, rows).where("user_id IS NOT NULL").groupBy("user_id").agg(F.count("*").alias("sessions"), F.sum("n").alias("n"))


def stream_state_changes(s, d):
    """Per user the events whose props differ from the user's last ones, by event number, over several batches."""
    rows = _fed(s, table(s, d, "events").select("user_id", "event_id", "props"), F.col("event_id"), "states")
    return _written(s, S.changed_only(rows, ("user_id",), "event_id", "props")).select("user_id", "event_id")


def stream_dedup(s, d):
    """One event for each user and day; state is kept for two days."""
    rows = _timed_events(s, d).select("user_id", "ts", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    return _written(s, S.first_within(rows, F.col("ts"), "2 days", "user_id", "day").select("user_id", "day")).where("user_id IS NOT NULL")


def stream_version_changes(s, d):
    """The change feed by state: of the versions of a record, in order of revision, those with new content."""
    rows = table(s, d, "record_versions").where("hash IS NOT NULL AND revision IS NOT NULL").select(F.concat_ws("|", "source", clean("key")).alias("record"), F.col("revision").cast("bigint").alias("revision"), sha256_of("hash").alias("hash"))
    return _written(s, S.changed_only(_fed(s, rows, F.col("revision"), "versions"), ("record",), "revision", "hash"))


QUERIES = {f.__name__: f for f in (stream_windows, stream_sliding, stream_sessions, stream_state_changes, stream_dedup, stream_version_changes)}
SQL = {
    "stream_windows": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL",
    "stream_sliding": "SELECT strftime(d, '%Y-%m-%d') AS day, count(*) AS n FROM (SELECT unnest([date_trunc('day', ts), date_trunc('day', ts) - INTERVAL 1 DAY]) AS d FROM events) GROUP BY 1",
    "stream_sessions": "SELECT user_id, count(*) FILTER (brk) AS sessions, count(*) AS n FROM (SELECT user_id, coalesce(ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 1 DAY, true) AS brk FROM events) GROUP BY user_id",
    "stream_state_changes": "SELECT user_id, event_id FROM (SELECT user_id, event_id, props, lag(props) OVER (PARTITION BY user_id ORDER BY event_id) AS before FROM events) WHERE props IS DISTINCT FROM before",
    "stream_dedup": "SELECT DISTINCT user_id, strftime(ts, '%Y-%m-%d') AS day FROM events",
    "stream_version_changes": r"WITH v AS (SELECT DISTINCT source || '|' || lower(regexp_replace(key, '^\s+|\s+$', '', 'g')) AS record, revision, regexp_extract(lower(trim(hash)), '([0-9a-f]{64})$', 1) AS hash FROM record_versions WHERE hash IS NOT NULL) SELECT record, revision, hash FROM (SELECT *, lag(hash) OVER (PARTITION BY record ORDER BY revision) AS before FROM v) WHERE hash IS DISTINCT FROM before",
}
