"""Column expressions; all of them are built-in Spark functions, none is a UDF."""
