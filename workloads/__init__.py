"""Queries over the given tables, one per operator, each with the SQL it must agree with."""
