"""Telecom and remittance analytics as Spark DataFrame, Structured Streaming and Spark ML jobs."""
