"""The command line: ``python -m catenary COMMAND``.

fmt [--check] FILE        canonical form of a document of claims (- reads standard input)
validate FOLDER           checks every artifact of a published folder (Parquet of path and content)
source-status FOLDER      heads and row counts of a folder of tables
source-show FOLDER KEY    the current record of a key
changes FOLDER SOURCE REVISION [LIMIT]   a page of the change feed
candidates FOLDER [LIMIT] candidate claims with their evidence counts
show FOLDER CLAIM         the supports of a claim
sync FOLDER STATE         brings the supports in STATE up to date with the records of FOLDER, and prints what was withdrawn
decide STATE RECORD ACTION NOTE   adds a decision (accepted, rejected, retracted) on a claim, given as a file with its record
publish STATE OUT         writes the decisions in force that are not retracted as artifacts
retain FOLDER DAYS        versions that nothing needs any more
query NAME FOLDER         any query of the catalogue
"""

from __future__ import annotations

import json
import sys

from .functions.claims import ClaimError, parse


def _session():
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("catenary").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _print(rows) -> None:
    for row in rows.toLocalIterator():
        print(json.dumps(row.asDict(recursive=True), default=str, ensure_ascii=False))


def fmt(path: str, check: bool) -> int:
    text = sys.stdin.read() if path == "-" else open(path, encoding="utf-8", newline="").read()
    try:
        canonical = "".join(r.canonical() for r in parse(text))
    except ClaimError as e:
        print(f"{path}: {e}", file=sys.stderr)
        return 2
    if check:
        return int(canonical != text)
    sys.stdout.write(canonical)
    return 0


def sync(spark, folder: str, state: str) -> None:
    """One step of linking: from scratch if nothing was written yet, else by what changed."""
    from .operators import pipeline as P
    from .plans.linking import live
    from .session import Cut
    from .sources.sinks import Ledger

    names = ("facts", "blocks", "supports", "projected")
    ledger = Ledger(spark, f"{state}/steps")
    steps = ledger.revisions()
    now = Cut(live(spark, folder), "live").df
    if steps:
        made = P.reprojected({n: spark.read.parquet(f"{state}/tables/{steps[-1]}/{n}") for n in names}, now)
        _print(made["withdrawn"].select("id", "statement", "method"))
    else:
        made = P.started(now)
    step = f"{len(steps) + 1:06d}"
    for n in names:
        made[n].write.mode("overwrite").parquet(f"{state}/tables/{step}/{n}")
    ledger.append(spark.createDataFrame([(step,)], "step string"), step)  # only now the step counts


def decide(spark, state: str, path: str, action: str, note: str) -> None:
    from .functions.claims import parse_record
    from .operators import pipeline as P
    from .sources.sinks import Ledger

    if action not in ("accepted", "rejected", "retracted") or not note.strip():
        raise SystemExit("an action is accepted, rejected or retracted, and needs a note")
    record = parse_record(open(path, encoding="utf-8", newline="").read())
    ledger = Ledger(spark, f"{state}/events")
    schema = "claim_id string, version bigint, record string, action string, note string"
    before = ledger.read() if ledger.revisions() else spark.createDataFrame([], schema)
    asked = spark.createDataFrame([(record.statement.claim_id(), record.canonical(), action, note, None)], "claim_id string, record string, action string, note string, replaces string")
    new = P.saved_decisions(before, asked)["events"].join(before.select("version"), "version", "left_anti").select("claim_id", "version", "record", "action", "note")
    ledger.append(new, f"{len(ledger.revisions()) + 1:06d}")


def main(args: list[str]) -> int:
    if not args:
        print(__doc__)
        return 2
    command, *rest = args
    if command == "fmt":
        return fmt([a for a in rest if a != "--check"][0], "--check" in rest)
    from pyspark.sql import functions as F

    from .operators import records as R
    from .operators import review as V
    from .plans import catalogue, linking, store

    spark = _session()
    if command == "validate":
        files = spark.read.parquet(rest[0]).select("path", V.checked_artifact("path", "content").alias("c"))
        bad = files.where("NOT c.ok").select("path", "c.error")
        _print(bad)
        return int(bad.count() > 0)
    if command == "source-status":
        _print(store.rec_heads(spark, rest[0]))
        _print(linking.link_status(spark, rest[0]))
    elif command == "source-show":
        _print(R.latest(store.versions(spark, rest[0])).where(F.col("key") == rest[1]))
    elif command == "changes":
        v = store.versions(spark, rest[0])
        through = v.where(F.col("source") == rest[1]).agg(F.max("revision")).first()[0]
        _print(R.changes_page(v, rest[1], (int(rest[2]), None), through, int(rest[3]) if len(rest) > 3 else R.PAGE))
    elif command == "candidates":
        _print(catalogue.QUERIES["link_candidates"](spark, rest[0]).orderBy("claim_id").limit(int(rest[1]) if len(rest) > 1 else 100))
    elif command == "show":
        _print(linking.supports(spark, rest[0]).where(F.col("claim_id") == rest[1]))
    elif command == "sync":
        sync(spark, rest[0], rest[1])
    elif command == "decide":
        decide(spark, *rest[:4])
    elif command == "publish":
        from .sources.sinks import Ledger

        decided = V.decisions(Ledger(spark, f"{rest[0]}/events").read()).select("claim_id", "record", "action", F.lit(None).cast("map<string,string>").alias("bindings"))
        V.write_artifacts(V.artifacts(decided), rest[1])
    elif command == "retain":
        v = store.versions(spark, rest[0])
        before = F.expr(f"CAST(current_timestamp() - make_interval(0, 0, 0, {int(rest[1])}) AS timestamp_ntz)")
        _print(R.removable(v, R.latest(v), spark.read.parquet(f"{rest[0]}/sources.parquet"), before, []))
    elif command == "query":
        _print(catalogue.QUERIES[rest[0]](spark, rest[1]))
    else:
        print(__doc__)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
