"""Queries over the given tables: each operator once, with the SQL it must agree with."""
