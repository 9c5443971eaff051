"""Sensor-stream analytics as Spark DataFrame operators, for batch and Structured Streaming."""
