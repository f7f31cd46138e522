"""Column expressions and name helpers the operators are built from."""
