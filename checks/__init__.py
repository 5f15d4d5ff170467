"""Inputs derived from the test tables, and the SQL that states the expected results."""
