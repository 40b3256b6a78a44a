"""Independent DuckDB oracle SQL for the registered queries."""
