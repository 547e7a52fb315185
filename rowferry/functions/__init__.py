"""Column expressions. Every function takes and returns ``Column`` and stays inside the JVM."""
