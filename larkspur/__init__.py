"""Larkspur: supervised-learning table jobs on Spark.

Every function takes a session or a DataFrame from the caller and returns
DataFrames (or fitted Spark ML models).  Nothing here sets a master.
"""
