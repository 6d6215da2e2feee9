"""Whole runs: incremental batch, day by day, and the catalogue of registered queries."""
