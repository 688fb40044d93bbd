"""Reviewing claims and publishing decisions: policy, footprints, violations, batches, artifacts, deltas."""

from __future__ import annotations

import json
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.claims import ClaimError, claim_id, parse_record
from .records import latest

#: Limits of a publication batch, of a file and of a note.
BATCH_FILES, BATCH_BYTES, FILE_BYTES, NOTE_BYTES = 999, 6 << 20, 2 << 20, 8192


def parse_policy(text: str) -> list[tuple[str, str]]:
    """The exclusive source pairs of a policy document, each sorted; anything unknown in it is an error."""
    policy = json.loads(text)
    if not isinstance(policy, dict) or set(policy) != {"format_version", "exclusive_source_pairs"} or policy["format_version"] != 1:
        raise ValueError("a policy has format_version 1 and exclusive_source_pairs")
    pairs = []
    for pair in policy["exclusive_source_pairs"]:
        if not isinstance(pair, list) or len(pair) != 2 or pair[0] == pair[1] or not all(isinstance(s, str) and s for s in pair):
            raise ValueError("a pair has two different sources")
        if (ordered := tuple(sorted(pair))) in pairs:
            raise ValueError("a pair occurs twice")
        pairs.append(ordered)
    return pairs


def policy_table(spark: SparkSession, pairs: list[tuple[str, str]]) -> DataFrame:
    """source_a, source_b: a row for each pair of sources, as many as the policy document has."""
    return spark.createDataFrame(pairs, "source_a string, source_b string")


def footprint(endpoints: DataFrame, pairs: DataFrame) -> DataFrame:
    """claim_id, origin, target_source, target: both directions of each claim between two sources that are exclusive to each other.
    ``endpoints``: claim_id, a_source, a, b_source, b. The policy has a few rows, so Spark broadcasts it by its size."""
    ways = endpoints.select("claim_id", F.col("a_source").alias("source"), F.col("a").alias("origin"), F.col("b_source").alias("target_source"), F.col("b").alias("target")).unionByName(
        endpoints.select("claim_id", F.col("b_source").alias("source"), F.col("b").alias("origin"), F.col("a_source").alias("target_source"), F.col("a").alias("target"))
    )
    rules = pairs.select(F.col("source_a").alias("source"), F.col("source_b").alias("target_source")).union(pairs.select("source_b", "source_a")).distinct()
    return ways.join(rules, ["source", "target_source"]).select("claim_id", "origin", "target_source", "target").distinct()


def policy_conflicts(found: DataFrame) -> DataFrame:
    """Origins with more than one target in an exclusive source."""
    return found.groupBy("origin", "target_source").agg(F.count_distinct("target").alias("targets")).where("targets > 1")


def decisions(events: DataFrame) -> DataFrame:
    """claim_id, action, version in force; retracted claims have none."""
    return latest(events, ("claim_id",), ("version",)).where("action <> 'retracted'")


def review_violations(requests: DataFrame, in_force: DataFrame, candidates: DataFrame, supported: DataFrame, judged: DataFrame, conflicts: DataFrame) -> DataFrame:
    """claim_id and message of everything against a review.

    ``requests``: claim_id, record, action, note, expected_version, expected_revision; ``candidates``: claim_id, revision;
    ``supported``: claims with current evidence; ``judged``: claim_id, verdict; ``conflicts``: claim_id of claims that break the policy.
    """
    rows = requests.join(in_force.select("claim_id", F.col("version").alias("__version")), "claim_id", "left").join(candidates.select("claim_id", F.col("revision").alias("__revision")), "claim_id", "left")
    rows = rows.join(supported.select("claim_id").distinct().withColumn("__supported", F.lit(True)), "claim_id", "left").join(judged.select("claim_id", F.col("verdict").alias("__verdict")), "claim_id", "left")
    rows = rows.join(conflicts.select("claim_id").distinct().withColumn("__conflict", F.lit(True)), "claim_id", "left")
    accepts = F.col("action") == "accepted"
    checks = [
        (F.trim(F.coalesce("note", F.lit(""))) == "", "a note is needed"),
        (F.octet_length("note") > NOTE_BYTES, "the note is too long"),
        (F.octet_length("record") > FILE_BYTES, "the record is too long"),
        (F.col("record").rlike(r"(?m)^#@(decision|resolve) "), "the record brings its own decision"),
        (~F.col("expected_version").eqNullSafe(F.col("__version")), "another decision came first"),
        (F.col("expected_revision").isNotNull() & ~F.col("expected_revision").eqNullSafe(F.col("__revision")), "the candidate changed"),
        (accepts & F.col("__revision").isNotNull() & F.col("__supported").isNull(), "no current evidence"),
        (accepts & F.col("__verdict").isNotNull() & F.col("__verdict").startswith("Invalid"), "the statement is invalid"),
        (accepts & F.coalesce("__conflict", F.lit(False)), "the policy excludes it"),
    ]
    return reduce(DataFrame.unionByName, [rows.where(c).select("claim_id", F.lit(m).alias("message")) for c, m in checks])


def publication_batch(pending: DataFrame, key: str = "claim_id", text: str = "record", files: int = BATCH_FILES, most_bytes: int = BATCH_BYTES) -> DataFrame:
    """The first pending rows by key that fit in a batch. The window runs over at most ``files`` rows, taken before."""
    first = pending.orderBy(key).limit(files)
    running = F.sum(F.octet_length(text)).over(Window.orderBy(key).rowsBetween(Window.unboundedPreceding, 0))
    return first.withColumn("bytes_so_far", running.cast("bigint")).where(F.col("bytes_so_far") <= most_bytes)


def artifact_path(claim: Column) -> Column:
    """claims/<first two digits>/<digits>.trk of a claim's id."""
    digits = F.regexp_replace(claim, "^v1:", "")
    return F.concat(F.lit("claims/"), F.substring(digits, 1, 2), F.lit("/"), digits, F.lit(".trk"))


def artifacts(decided: DataFrame) -> DataFrame:
    """path, content of decided records (claim_id, record, action, bindings map or null): metadata, resolution, decision, statement."""
    resolve = F.when(F.col("bindings").isNotNull(), F.concat(F.lit("#@resolve "), F.to_json("bindings"), F.lit("\n"))).otherwise("")
    decision = F.concat(F.lit("#@decision "), F.col("action"), F.lit("\n"))
    head, last = F.regexp_extract("record", r"(?s)^(.*\n)?([^\n]+)\n$", 1), F.regexp_extract("record", r"(?s)^(.*\n)?([^\n]+)\n$", 2)
    return decided.select(artifact_path(F.col("claim_id")).alias("path"), F.concat(F.coalesce(head, F.lit("")), resolve, decision, last, F.lit("\n")).alias("content"))


def write_artifacts(files: DataFrame, folder: str) -> None:
    """One row for each file, in folders by shard."""
    files.withColumn("shard", F.substring(F.regexp_extract("path", r"claims/([0-9a-f]{2})/", 1), 1, 2)).write.mode("overwrite").partitionBy("shard").parquet(folder)


_CHECKED = T.StructType([T.StructField("ok", T.BooleanType()), T.StructField("error", T.StringType())])


@F.pandas_udf(_CHECKED)
def checked_artifact(paths: pd.Series, contents: pd.Series) -> pd.DataFrame:
    """Whether a file is a canonical record with one decision as its last metadata line, of a fair size, at its own path."""
    out = []
    for path, content in zip(paths, contents):
        error = None
        try:
            record = parse_record(content or "")
            marks = [line for line in record.metadata if line.startswith("#@decision ")]
            digits = record.statement.claim_id().removeprefix("v1:")
            if len((content or "").encode()) > FILE_BYTES:
                error = "too long"
            elif record.canonical() != content:
                error = "not canonical"
            elif len(marks) != 1 or record.metadata[-1] != marks[0] or marks[0].split(" ")[-1] not in ("accepted", "rejected"):
                error = "one decision must come last"
            elif path != f"claims/{digits[:2]}/{digits}.trk":
                error = "wrong path"
        except ClaimError as e:
            error = str(e)
        out.append((error is None, error))
    return pd.DataFrame(out, columns=["ok", "error"])


def delta(before: DataFrame, after: DataFrame, key: str = "path", content: str = "content") -> DataFrame:
    """key, change (added, changed, deleted) and the content after it."""
    both = before.select(key, F.col(content).alias("__old")).join(after.select(key, F.col(content).alias("__new")), key, "full_outer")
    change = F.when(F.col("__old").isNull(), "added").when(F.col("__new").isNull(), "deleted").when(F.col("__old") != F.col("__new"), "changed")
    return both.select(key, change.alias("change"), F.col("__new").alias(content)).where("change IS NOT NULL")


def binding_map(resolutions: DataFrame) -> DataFrame:
    """claim_id and its bindings: selection key to the units it stands for, or to the error, which is published, not raised."""
    entry = F.struct("selection_key", F.coalesce(F.array_join("units", ","), F.concat(F.lit("!"), "error")).alias("value"))
    return resolutions.groupBy("claim_id").agg(F.map_from_entries(F.array_sort(F.collect_set(entry))).alias("bindings"))


def resolved_from(selections: DataFrame, bindings: DataFrame) -> DataFrame:
    """claim_id, selection_key, units of published bindings; null units where nothing was published."""
    flat = bindings.select("claim_id", F.explode("bindings").alias("selection_key", "value"))
    return selections.join(flat, ["claim_id", "selection_key"], "left").select("claim_id", "selection_key", F.when(~F.col("value").startswith("!"), F.split("value", ",")).alias("units"))


def endpoints(claims: DataFrame) -> DataFrame:
    """claim_id, a_source, a, b_source, b of claims between two bare references (column statement)."""
    parts = F.split("statement", " (<=>|<~>|=>) ")
    a, b = F.element_at(parts, 1), F.element_at(parts, 2)
    source = lambda c: F.substring_index(c, "://", 1)
    return claims.select(claim_id(F.col("statement")).alias("claim_id"), source(a).alias("a_source"), a.alias("a"), source(b).alias("b_source"), b.alias("b"))
