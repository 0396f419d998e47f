"""Sources and sinks: telemetry messages and CSV files, the camera registry, the
driver-table fixture adapter, the CSV sink and the violation store."""
