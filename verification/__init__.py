"""Stand-in feeds, registered queries and their DuckDB counterparts."""
