"""Registered queries: one per operator, run on the given tables, each with SQL where SQL can say it."""
