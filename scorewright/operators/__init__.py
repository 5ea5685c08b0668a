"""Operators: DataFrame in, DataFrame out, lazy unless the docstring names the jobs they run."""
