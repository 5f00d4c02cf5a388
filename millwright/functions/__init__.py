"""Column expressions: no Python runs per row, everything stays in the JVM."""
