"""Column expressions. Everything here stays JVM-side; there is no UDF."""
