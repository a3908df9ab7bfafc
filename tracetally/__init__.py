"""Developer-telemetry reports over a wide trace table, as plain PySpark DataFrame functions."""
