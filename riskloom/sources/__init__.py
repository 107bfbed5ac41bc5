"""Readers: event payloads, tables and the test-data adapter."""
