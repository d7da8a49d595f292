"""Operators bound to the test tables, each with an independently written SQL statement."""
