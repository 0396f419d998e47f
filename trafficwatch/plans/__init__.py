"""Query plans over detections and the store: lookups, reports and counters,
quality checks, result presentation and the DuckDB statements of the oracle."""
