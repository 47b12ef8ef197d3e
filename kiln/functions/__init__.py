"""Column expressions (scalar, text, date, array maths) built from Spark SQL functions."""
