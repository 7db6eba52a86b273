"""The data-quality operators. Each works on DataFrames and leaves execution to Spark."""
