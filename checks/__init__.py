"""Registered queries over the test tables, and the SQL each result is compared with."""
