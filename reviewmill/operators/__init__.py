"""Functions from DataFrame to DataFrame: cleaning, profiling, grouping, features, metrics."""
