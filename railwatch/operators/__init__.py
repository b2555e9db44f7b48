"""Operators: DataFrames in, one DataFrame out. None of them runs a job except where its docstring says so."""
