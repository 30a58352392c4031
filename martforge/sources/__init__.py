"""Readers, writers and the TESTDATA-derived inputs."""
