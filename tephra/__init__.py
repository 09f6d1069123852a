"""tephra: layered telemetry tables on Spark: ingest, conform, version, aggregate, check."""
