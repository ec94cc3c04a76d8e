"""DataFrame operators: each takes DataFrames and explicit settings and returns a DataFrame."""
