"""Queries over the tables, by operator, each with SQL where SQL can express it."""
