"""Spark-native corpus verification, lineage and run telemetry."""
