"""Spark jobs and DataFrame operators for content telemetry and recommendation data."""
