"""Operators: functions and small objects that turn DataFrames into DataFrames."""
