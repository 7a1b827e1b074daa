"""Column-level expressions (scalar, date, string, array) built from Spark SQL functions."""
