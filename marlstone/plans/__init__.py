"""Registered queries: each one a Spark plan over the given tables, with its SQL twin."""
