"""Column functions; all of them stay inside generated JVM code."""
