"""Readers, writers and the binding of the supplied tables to the raw inputs."""
