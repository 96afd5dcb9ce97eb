"""Medallion analytics for popularity snapshots, written as plain Spark jobs."""
