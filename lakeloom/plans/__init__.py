"""Composed jobs (harmonize a table, publish snapshots) and the registered queries."""
