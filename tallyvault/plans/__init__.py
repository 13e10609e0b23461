"""Plans: the query registry, its DuckDB oracle, the pipeline and layout."""
