"""Operators: functions from DataFrames to DataFrames, usable with ``DataFrame.transform``."""
