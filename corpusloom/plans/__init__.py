"""Queries: operators applied to the test tables, and the SQL that states the same."""
