"""Column expressions (and the one Arrow UDF) used by the operators."""
