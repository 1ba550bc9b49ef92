"""Column expressions: they run inside the JVM and need no shuffle."""
