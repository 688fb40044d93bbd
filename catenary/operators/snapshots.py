"""What changed between full snapshots (problem 4).

Method: content-defined chunks of key-sorted snapshots. The keys of all snapshots are split into parts by hash, alike for all of
them, and sorted in each; a chunk ends where a key's hash says so, hence at the same keys in every snapshot that has them. Chunks
whose digest equals that of the snapshot before are discarded whole; only rows of the others are compared.

One exchange brings the snapshots together; folding, chunks, digests and comparison need no other. A row travels as its key
and one binary value, its rank, that sorts as revision, deletion and content do, with a SHA-256 in 32 bytes. Before the exchange
each batch keeps only the row with the highest rank of a key and run, so that a key delivered very often stays small. A digest is
right only of folded rows, as deliveries repeat and bring stale rows, so rows are moved once even where chunks turn out equal; a
part is read in batches, of which one open chunk is held back.

Defined results:

* Of several rows for a key in a run the one with the highest revision counts; of equal revisions a deleted one, then the
  greatest hash, a well-formed one before any other. A row with a null revision counts as older than any other.
* Rows without key, source or run, and of runs that are not complete full ones, are in no snapshot.
* A null hash is a value of its own: null to null is no change.
* The first snapshot of a source has none before it and gives nothing. A run that delivered no rows is an empty snapshot.
* A null ``deleted`` counts as not deleted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.text import clean, sha256_of

#: A chunk ends before a key of whose hash so many low bits are zero: 64 keys on average.
CHUNK_BITS = 6


def full_runs(runs: DataFrame) -> DataFrame:
    """source, run_id, number (0, 1, ... in order of started_at) and count of each source's complete full runs. The table has a
    row per run, so its windows are small."""
    w = Window.partitionBy("source")
    return (
        runs.where((F.col("mode") == "full") & (F.col("status") == "complete"))
        .select("source", "run_id", F.row_number().over(w.orderBy("started_at", "run_id")).alias("number"), F.count("*").over(w).cast("int").alias("count"))
        .withColumn("number", F.col("number") - 1)
    )


def _rank() -> Column:
    """Revision (null before any), deletion and content of a row as bytes in that order; the content begins at byte CONTENT."""
    revision = F.col("revision").cast("bigint")
    number = F.when(revision.isNull(), F.lit(b"\0" * 9)).otherwise(F.concat(F.lit(b"\1"), F.unhex(F.lpad(F.hex(revision.bitwiseXOR(F.lit(-(1 << 63)))), 16, "0"))))
    gone = F.when(F.coalesce("deleted", F.lit(False)), F.lit(b"\1")).otherwise(F.lit(b"\0"))
    spelled = sha256_of("hash")
    content = F.when(spelled.isNull(), F.lit(b"\0")).when(spelled.rlike("^[0-9a-f]{64}$"), F.concat(F.lit(b"\2"), F.unhex(spelled))).otherwise(F.concat(F.lit(b"\1"), F.encode(spelled, "UTF-8")))
    return F.concat(number, gone, content)


#: Where in a rank the deletion and the content stand (from 1).
DELETED, CONTENT = 10, 11


def delivered(records: DataFrame, runs: DataFrame) -> DataFrame:
    """source, key, number, count, rank of the rows of snapshots; of a batch's rows for a key in a run the one with the highest rank."""
    rows = records.select("source", clean("key").alias("key"), F.col("seen_run").alias("run_id"), _rank().alias("rank")).where(F.col("key").isNotNull())
    rows = rows.join(full_runs(runs), ["source", "run_id"]).select("source", "key", F.col("number").cast("int").alias("number"), F.col("count").cast("int").alias("count"), "rank")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            folded = pa.Table.from_batches([batch]).group_by(["source", "key", "number", "count"]).aggregate([("rank", "max")])
            yield from folded.rename_columns(["source", "key", "number", "count", "rank"]).to_batches()

    return rows.mapInArrow(run, rows.schema)


_RESULT = T.StructType([T.StructField("source", T.StringType()), T.StructField("number", T.IntegerType()), T.StructField("key", T.StringType()), T.StructField("change", T.StringType())])


def _changed(rows: pa.Table) -> pa.RecordBatch | None:
    """The changes in whole chunks of rows sorted by source, key, number and rank."""
    # of the rows of a key in a snapshot the last one counts, if it is not deleted
    number, same = rows.column("number").to_numpy(), rows.column("same").to_numpy()
    alike = (same[1:] == same[:-1]) & (number[1:] == number[:-1])
    for column in ("key", "source"):  # equal 64 bits are compared as text
        text = rows.column(column).combine_chunks()
        alike &= pc.equal(text[1:], text[:-1]).to_numpy(zero_copy_only=False)
    last = np.append(~alike, True)
    rows = rows.filter(pa.array(last & ~rows.column("deleted").to_numpy()))
    n = rows.num_rows
    if not n:
        return None
    number, count, cut = (rows.column(c).to_numpy() for c in ("number", "count", "cut"))
    same = rows.column("same").to_numpy()  # 64 bits of source and key: equal neighbours are compared as text below
    digest = rows.column("digest").to_numpy().view(np.uint64)
    source, key, content = (rows.column(c).combine_chunks() for c in ("source", "key", "content"))
    first = np.ones(n, bool)
    first[1:] = (same[1:] != same[:-1]) | ~(pc.equal(key[1:], key[:-1]).to_numpy(zero_copy_only=False) & pc.equal(source[1:], source[:-1]).to_numpy(zero_copy_only=False))
    turn = np.ones(n, bool)
    turn[1:] = ~pc.equal(source[1:], source[:-1]).to_numpy(zero_copy_only=False)
    chunk = np.cumsum((first & cut) | turn) - 1
    width = int(count.max()) + 1
    # digests of each chunk in each snapshot: two sums of hashes that are drawn apart
    cell = chunk * width + number
    other = (digest * np.uint64(0x9E3779B97F4A7C15)) ^ (digest >> np.uint64(29))
    other *= np.uint64(0xBF58476D1CE4E5B9)
    sums = np.zeros((3, (int(chunk[-1]) + 1) * width), np.uint64)
    np.add.at(sums[0], cell, digest)
    np.add.at(sums[1], cell, other ^ (other >> np.uint64(32)))
    np.add.at(sums[2], cell, np.uint64(1))
    sums = sums.reshape(3, -1, width)
    differs = np.zeros(sums.shape[1:], bool)
    differs[:, 1:] = (sums[:, :, 1:] != sums[:, :, :-1]).any(axis=0)
    differs = differs.reshape(-1)

    # rows of chunks that differ from the snapshot before, or from which the one after differs
    has_last = np.zeros(n, bool)
    has_last[1:] = ~first[1:] & (number[1:] == number[:-1] + 1)
    has_next = np.append(has_last[1:], False)
    unlike = np.zeros(n, bool)
    unlike[1:] = ~pc.equal(content[1:], content[:-1]).to_numpy(zero_copy_only=False)
    here, after = differs[cell], np.where(number + 1 < count, differs[np.minimum(cell + 1, len(differs) - 1)], False)
    picks = [(np.flatnonzero(here & (number > 0) & ~has_last), 0, "added"), (np.flatnonzero(here & has_last & unlike), 0, "changed"), (np.flatnonzero(after & ~has_next), 1, "removed")]
    at = np.concatenate([p for p, _, _ in picks])
    if not len(at):
        return None
    take = pa.array(at)
    return pa.RecordBatch.from_pydict(
        {
            "source": source.take(take),
            "number": pa.array(np.concatenate([number[p] + d for p, d, _ in picks]).astype(np.int32)),
            "key": key.take(take),
            "change": pa.array(np.repeat([c for _, _, c in picks], [len(p) for p, _, _ in picks]), pa.string()),
        }
    )


def _by_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passes on whole chunks, holding back the last, open one of each batch."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        cut = batch.column("cut").to_numpy(zero_copy_only=False)
        same = batch.column("same").to_numpy()
        starts = np.flatnonzero(cut & np.append(False, same[1:] != same[:-1]))  # a chunk may start here
        if len(starts):
            at = int(starts[-1])
            if (out := _changed(pa.Table.from_batches([*held, batch.slice(0, at)]))) is not None:
                yield out
            held = [batch.slice(at)]
        else:
            held.append(batch)
    if held and (out := _changed(pa.Table.from_batches(held))) is not None:
        yield out


def snapshot_changes(records: DataFrame, runs: DataFrame, chunk_bits: int = CHUNK_BITS) -> DataFrame:
    """source, run_id, key, change: ``added``, ``removed`` or ``changed`` against the complete full run before."""
    # a key's rows lie together whatever their number, and a part's border is a chunk's
    rows = delivered(records, runs).repartition("source", "key").sortWithinPartitions("source", "key", "number", "rank").select(
        "source", "key", "number", "count",
        (F.substring("rank", DELETED, 1) == F.lit(b"\1")).alias("deleted"),
        F.expr(f"substring(rank, {CONTENT})").alias("content"),
        (F.xxhash64("key").bitwiseAND((1 << chunk_bits) - 1) == 0).alias("cut"),
        F.xxhash64("source", "key").alias("same"),
        F.xxhash64("key", F.expr(f"substring(rank, {CONTENT})")).alias("digest"),
    )
    found = rows.mapInArrow(_by_chunks, _RESULT)
    names = full_runs(runs).select("source", "run_id", "number")
    return found.join(names, ["source", "number"]).select("source", "run_id", "key", "change")
