"""Jobs (clean, star, load), the registered query catalog and its DuckDB oracles."""
