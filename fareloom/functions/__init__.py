"""Column expressions: everything here stays on the JVM except ``python_udfs``."""
