"""Readers, writers, generators and test-data adapters."""
