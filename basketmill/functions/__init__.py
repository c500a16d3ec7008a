"""Column expressions used by the jobs. All of them are built-in Spark expressions."""
