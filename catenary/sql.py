"""Everything reachable from spark.sql: functions and views."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .functions.claims import ClaimError, parse, parsed
from .functions.content import content_hash, normalize_title
from .sources.catalogs import register as register_sources
from .sources.tables import table

TABLES = ("sources", "sync_runs", "record_versions", "records", "episodes", "unit_pairs", "documents", "eval_items", "languages")


@F.udtf(returnType="record int, ok boolean, error string, canonical string, claim_id string, metadata string")
class ParseDocument:
    """The records of a document of claims, one row each; one row with the error for a document that is none."""

    def eval(self, text: str):
        try:
            records = parse(text or "")
        except ClaimError as e:
            yield 0, False, str(e), None, None, None
            return
        for i, r in enumerate(records):
            yield i, True, None, r.statement.canonical(), r.statement.claim_id(), "\n".join(r.metadata)


def register(spark: SparkSession, folder: str | None = None) -> None:
    """Registers parse_claim, normalize_title and content_hash, the table function parse_document, the sources, and with ``folder`` its tables as views."""
    spark.udf.register("parse_claim", parsed())
    spark.udf.register("normalize_title", normalize_title)
    spark.udf.register("content_hash", content_hash)
    spark.udtf.register("parse_document", ParseDocument)
    register_sources(spark)
    if folder:
        for name in TABLES:
            table(spark, folder, name).createOrReplaceTempView(name)
