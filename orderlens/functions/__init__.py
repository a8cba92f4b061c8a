"""Column expressions; all are built-in Spark functions, none is a UDF."""
