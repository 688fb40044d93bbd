"""Writing tables so that a reader sees all of a write or none of it."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession


class Ledger:
    """A table of Parquet parts and a list of those that count.

    A write goes to a folder of its own, named by a revision; then one small file, written under another name and renamed, adds
    the folder to the list. A write that dies leaves a folder that no list names; repeating a revision replaces nothing and
    changes nothing, so replays are harmless. Manifests are JSON files 000001.json, 000002.json, ...
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _names(self, sub: str) -> list[str]:
        at = self._path(f"{self.folder}/{sub}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def _parts(self) -> list[tuple[str, str]]:
        """Revision and folder of what was written, in order: one small read of all manifests."""
        names = [n for n in self._names("manifests") if n.endswith(".json")]
        if not names:
            return []
        lines = self.spark.read.text([f"{self.folder}/manifests/{n}" for n in names]).select("value", "_metadata.file_name").collect()
        return [(m["revision"], m["part"]) for _, m in sorted((r[1], json.loads(r[0])) for r in lines)]

    def revisions(self) -> list[str]:
        """The revisions written, in order."""
        return [r for r, _ in self._parts()]

    def append(self, rows: DataFrame, revision: str) -> bool:
        """Adds a revision; false if it was there already. Each write has a folder of its own, so that of two writers of one revision
        the one whose manifest comes second leaves the other's rows alone, and fails."""
        if revision in self.revisions():
            return False
        part = f"{revision}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.folder}/parts/{part}")
        number = len([n for n in self._names("manifests") if n.endswith(".json")]) + 1
        draft, final = self._path(f"{self.folder}/manifests/_{part}"), self._path(f"{self.folder}/manifests/{number:06d}.json")
        out = self._fs.create(draft, True)
        out.write(bytearray((json.dumps({"revision": revision, "part": part}) + "\n").encode()))
        out.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            raise RuntimeError("another writer was first")
        return True

    def read(self, until: str | None = None) -> DataFrame:
        """All revisions, or those up to one."""
        known = self._parts()
        if until is not None:
            known = known[: [r for r, _ in known].index(until) + 1]
        if not known:
            raise ValueError("nothing written yet")
        return self.spark.read.parquet(*[f"{self.folder}/parts/{part}" for _, part in known])
