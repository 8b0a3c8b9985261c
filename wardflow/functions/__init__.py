"""Column-level building blocks; every function maps columns to a column and stays in the JVM."""
