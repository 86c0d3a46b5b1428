"""Training-data operators: each takes and returns Spark DataFrames.

Nothing outside this subpackage imports it.  ``registry`` holds the queries
built on the operators and their reference SQL.
"""
