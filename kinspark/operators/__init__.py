"""Operators: DataFrame -> DataFrame functions, no collect, no Python UDF."""
