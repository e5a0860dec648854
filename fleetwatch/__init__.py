"""Device telemetry, threshold alerts and their life cycle as Spark DataFrame jobs."""
