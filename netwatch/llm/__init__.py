"""Operators on the texts of a training corpus."""
