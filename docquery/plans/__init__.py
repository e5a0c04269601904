"""Queries over the test tables, each with the same result written in SQL where SQL can say it."""
