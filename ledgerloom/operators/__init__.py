"""The jobs: each a function from DataFrames to DataFrames."""
