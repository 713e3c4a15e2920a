"""Queries over the sample tables, with the SQL that states their results."""
