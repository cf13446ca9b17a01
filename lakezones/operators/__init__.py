"""Operators: ledger, change detection, row numbers, joins, profile,
sampling and ML.  Each is a function over DataFrames."""
