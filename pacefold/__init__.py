"""Activity telemetry on Spark: typed feeds, reports, alerts and streams."""
