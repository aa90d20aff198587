"""Operators: DataFrame(s) and parameters in, DataFrame out."""
