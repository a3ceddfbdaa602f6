"""Batch analytics over trips, sales and franchises, built from Spark DataFrame operators."""
