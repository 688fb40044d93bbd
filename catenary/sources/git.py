"""Publishing artifacts into a bare Git repository, and reading what changed between two commits. Optional: it needs the git program.

A publication has two steps. ``prepare`` makes the commit's objects without moving the branch: its content, author and time are given,
so that the same publication is the same commit. ``apply`` moves the branch from the commit it was made on to the new one, and fails
if another came first; a publication that was prepared but not applied is applied, or prepared again, after a crash. Files come from
a publication batch, which is bounded in files and bytes, so they pass through the driver.
"""

from __future__ import annotations

import re
import subprocess
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession

from ..operators.review import BATCH_BYTES, BATCH_FILES

_COMMIT, _BRANCH, _PATH = re.compile("[0-9a-f]{40}|[0-9a-f]{64}"), re.compile(r"[A-Za-z0-9][A-Za-z0-9._/-]*"), re.compile(r"claims/[0-9a-f]{2}/[0-9a-f]{64}\.trk")
#: Seconds that a command may take.
TIMEOUT = 120


class History:
    """A branch of a bare repository, which is made if it is not there."""

    def __init__(self, folder: str, branch: str = "main"):
        if not _BRANCH.fullmatch(branch) or ".." in branch or branch.endswith((".lock", "/", ".")):
            raise ValueError("no name of a branch")
        self.folder, self.ref = folder, f"refs/heads/{branch}"
        subprocess.run(["git", "init", "--quiet", "--bare", folder], check=True, timeout=TIMEOUT)

    def _git(self, *args: str, data: bytes | None = None) -> bytes:
        done = subprocess.run(["git", "--git-dir", self.folder, *args], input=data, capture_output=True, timeout=TIMEOUT)
        if done.returncode:
            raise RuntimeError(done.stderr.decode(errors="replace").strip() or f"git {args[0]} failed")
        return done.stdout

    def head(self) -> str | None:
        found = subprocess.run(["git", "--git-dir", self.folder, "rev-parse", "--verify", "--quiet", self.ref], capture_output=True, timeout=TIMEOUT)
        return found.stdout.decode().strip() or None

    def prepare(self, files: DataFrame, message: str, seconds: int) -> str:
        """The commit with files (path, content; a null content deletes) on the branch's head. The branch stays where it is."""
        rows = sorted((r["path"], r["content"]) for r in files.select("path", "content").limit(BATCH_FILES + 1).collect())
        if len(rows) > BATCH_FILES or sum(len((c or "").encode()) for _, c in rows) > BATCH_BYTES:
            raise ValueError("too much for one publication")
        if bad := [p for p, _ in rows if not _PATH.fullmatch(p)]:
            raise ValueError(f"no path of an artifact: {bad[0]}")
        base, text = self.head(), message.encode()
        draft = f"refs/drafts/{seconds}"
        out = [f"commit {draft}\n", f"committer catenary <catenary@localhost> {seconds} +0000\n", f"data {len(text)}\n", message, "\n", f"from {base}\n" if base else ""]
        stream = "".join(out).encode()
        for path, content in rows:
            body = (content or "").encode()
            stream += f"D {path}\n".encode() if content is None else f"M 100644 inline {path}\ndata {len(body)}\n".encode() + body + b"\n"
        self._git("fast-import", "--quiet", "--force", data=stream)
        commit = self._git("rev-parse", draft).decode().strip()
        self._git("update-ref", "-d", draft)
        return commit

    def apply(self, commit: str, base: str | None) -> None:
        """Moves the branch from base (None: it was not there) to the commit; an error if it is somewhere else."""
        if not _COMMIT.fullmatch(commit):
            raise ValueError("no commit")
        if self.head() != commit:  # applied before: nothing to do
            self._git("update-ref", self.ref, commit, base or "0" * len(commit))

    def changes(self, base: str | None, commit: str) -> Iterator[tuple[str, str, str | None]]:
        """path, change (added, changed, deleted) and content after it, of what lies between two commits."""
        if base is None:
            listed = [("A", p.decode()) for p in self._git("ls-tree", "-r", "-z", "--name-only", commit).split(b"\0") if p]
        else:
            parts = [p.decode() for p in self._git("diff-tree", "-r", "-z", "--no-renames", "--name-status", base, commit).split(b"\0") if p]
            listed = list(zip(parts[::2], parts[1::2]))
        for kind, path in listed:
            yield path, {"A": "added", "M": "changed", "D": "deleted"}[kind], None if kind == "D" else self._git("cat-file", "blob", f"{commit}:{path}").decode()

    def delta(self, spark: SparkSession, base: str | None, commit: str, files: int = 1000, most_bytes: int = 8 << 20) -> Iterator[DataFrame]:
        """The changes as DataFrames of at most so many files and bytes each (a larger file comes alone)."""
        for some in batched(self.changes(base, commit), files, most_bytes):
            yield spark.createDataFrame(some, "path string, change string, content string")


def batched(rows: Iterable[tuple[str, str, str | None]], files: int, most_bytes: int) -> Iterator[list[tuple]]:
    batch, size = [], 0
    for row in rows:
        length = len((row[2] or "").encode())
        if batch and (len(batch) == files or size + length > most_bytes):
            yield batch
            batch, size = [], 0
        batch.append(row)
        size += length
    if batch:
        yield batch
