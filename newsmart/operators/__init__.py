"""Pipeline operators: functions from DataFrames to DataFrames."""
