"""Spark-native analytics for hourly monitoring measurements.

Every operator is a function from DataFrames (or Columns) to a DataFrame (or
Column).  Nothing here runs an action unless its docstring says so.
"""
