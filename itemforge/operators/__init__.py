"""Relational operators: joins, aggregates, windows and rules over DataFrames."""
