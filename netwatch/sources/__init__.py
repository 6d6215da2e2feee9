"""Readers: CSV logs, message streams, marks, and the log view over the events table."""
