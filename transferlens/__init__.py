"""transferlens: transfer-ledger analytics as Spark DataFrame functions.

Operators take and return DataFrames; none of them holds a session, a path or a clock.
"""
