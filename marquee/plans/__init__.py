"""Analytical scenarios and batch ingestion jobs."""
