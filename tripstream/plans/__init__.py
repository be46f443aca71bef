"""Named query plans over the given tables, and their DuckDB oracles."""
