"""Column-expression builders; everything here stays on the JVM side."""
