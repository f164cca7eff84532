"""Plans: the registered query catalogue, its DuckDB oracle, and the
end-to-end ingestion / summarisation runs with their table writes."""
