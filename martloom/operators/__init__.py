"""Relational operators: DataFrame in, DataFrame out, all lazy unless said otherwise."""
