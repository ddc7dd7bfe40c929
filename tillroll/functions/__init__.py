"""Column-level building blocks, all of them built-in Spark expressions."""
