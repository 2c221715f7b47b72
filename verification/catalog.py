"""All registered queries."""

from verification import (  # noqa: F401
    batch_queries,
    check_queries,
    clean_queries,
    gold_queries,
    join_queries,
    merge_queries,
    silver_sql,
    source_queries,
)
from verification.registry import duckdb_queries, spark_queries  # noqa: F401
