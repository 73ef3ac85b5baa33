"""Column expressions and name rules; everything here stays inside the JVM."""
