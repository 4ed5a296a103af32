"""Whole plans: ingestion, enrichment, evaluation, query API, maintenance."""
