"""Column-expression builders (all JVM-side, no Python per row)."""
