"""Queries over the test tables, and the SQL statements they are checked against."""
