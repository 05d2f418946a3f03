"""Column expressions: DataFrame columns in, DataFrame columns out."""
