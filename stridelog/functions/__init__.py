"""Column expressions and order-based helpers the operators are built from."""
