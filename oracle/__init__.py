"""Independent SQL (DuckDB dialect) for every registered query.

The same test-table rules as ``waitlens.sources.testviews`` are written here as
SQL views, and each analysis is written again in plain SQL. The driver runs
these next to the Spark queries and compares the results.
"""

from oracle.queries import ORACLE_SQL  # noqa: F401
