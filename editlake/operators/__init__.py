"""Operators: functions from DataFrames to DataFrames, lazy and keyed by sample or contrast."""
