"""Query compositions over the driver tables, and their DuckDB oracles."""
