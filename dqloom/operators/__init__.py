"""The checks and profiles, each a function from DataFrames to a DataFrame."""
