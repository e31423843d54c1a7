"""Layered event analytics on Spark: ingest, enrich, profile, model, validate, export."""
