"""Column expressions. All are built from Spark's own functions and stay in the JVM."""
