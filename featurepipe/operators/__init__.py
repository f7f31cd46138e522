"""The operators: functions from DataFrames to DataFrames, most of them split into fit and transform."""
