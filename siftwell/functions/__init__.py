"""Column helpers, value frequencies and quantiles used by the operators."""
