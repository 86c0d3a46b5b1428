"""salesmart: a Spark-native sales reporting mart.

Builds the spare-part sales fact table from ERP-style tables, checks it
against its column contract and publishes it either as a full replacement
or as a trailing-window replacement that keeps older and protected rows.
"""

__version__ = "0.1.0"
