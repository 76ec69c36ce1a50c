"""Fraud classification on the fraud mart with Spark ML."""
