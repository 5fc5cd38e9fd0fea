"""Plans: the batch plan, the registered queries and their DuckDB oracles."""
