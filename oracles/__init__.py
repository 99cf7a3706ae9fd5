"""DuckDB twins of the registered queries, used only to check their results."""
