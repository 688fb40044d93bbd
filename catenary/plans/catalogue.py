"""All queries outside the subpackage llm."""

from . import alignment, catalog, linking, problems, store, streams

QUERIES = problems.QUERIES | store.QUERIES | linking.QUERIES | catalog.QUERIES | alignment.QUERIES | streams.QUERIES
SQL = problems.SQL | store.SQL | linking.SQL | catalog.SQL | alignment.SQL | streams.SQL
