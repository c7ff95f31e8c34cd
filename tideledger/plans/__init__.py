"""Domain pipelines: functions from DataFrames to one DataFrame."""
