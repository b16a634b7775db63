"""Structured Streaming carriers: file-ledger ingest with availableNow triggers."""
