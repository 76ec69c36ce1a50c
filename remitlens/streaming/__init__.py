"""Structured Streaming forms of the ingest, staging and fact models."""
