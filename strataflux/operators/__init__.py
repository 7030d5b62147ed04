"""Operators: functions from DataFrames to DataFrames, without input or output of their own."""
