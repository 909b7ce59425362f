"""Telemetry health and review sentiment analytics as Spark jobs."""
