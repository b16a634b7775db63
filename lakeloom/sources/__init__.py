"""Readers: test-table mapping, raw-layer file loads."""
