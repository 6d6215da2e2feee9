"""Operators on frames: each takes a DataFrame first and returns a lazy DataFrame."""
