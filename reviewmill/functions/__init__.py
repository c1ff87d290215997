"""Column expressions: numeric rounding, text metrics, labels and periods."""
