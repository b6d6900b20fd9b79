"""Spark jobs and operators that turn scientific records into text tables and retrieval pairs.

Every function takes and returns DataFrames or Columns. The library never creates a session.
"""
