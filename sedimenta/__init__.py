"""Layered ingestion and JSON normalisation on Spark."""
