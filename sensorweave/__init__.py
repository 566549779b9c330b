"""Sensor telemetry analytics as Spark DataFrame and Structured Streaming jobs."""
