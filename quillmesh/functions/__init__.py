"""Column expressions evaluated inside the JVM."""
