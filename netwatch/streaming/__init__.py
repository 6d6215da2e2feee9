"""Detectors on streams, and the tables they keep."""
