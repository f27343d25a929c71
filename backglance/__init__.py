"""Column-parameterised Spark operators for look-back joins, time-ordered splits and model tables.

Every operator takes DataFrames and column names and returns DataFrames, so that
Catalyst sees one declarative plan.  What comes to the driver is limited to
summaries whose size depends on the number of columns, never on the number of rows.
"""
