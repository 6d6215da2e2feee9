"""Column helpers: each takes and returns Columns, all evaluated inside the JVM."""
