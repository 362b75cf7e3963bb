"""Spark-first analytics over nested scholarly snapshots."""
