"""Security-log analytics as Spark DataFrame jobs, the same code for batch and stream."""
