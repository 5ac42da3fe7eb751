"""Column expressions. Every one is a built-in JVM expression; none is a Python UDF."""
