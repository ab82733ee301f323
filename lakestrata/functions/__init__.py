"""Column-level building blocks (all JVM-side built-in expressions)."""
