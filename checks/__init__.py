"""The library on the given test tables: inputs, query registry, DuckDB oracles."""
