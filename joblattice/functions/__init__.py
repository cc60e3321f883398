"""Column expressions: every function takes and returns a ``Column`` and stays in the JVM."""
