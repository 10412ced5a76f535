"""Operators: DataFrame in, DataFrame out, the same for tables and streams."""
