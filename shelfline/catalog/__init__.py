"""Registered queries over stand-in tables, and the SQL they are checked against."""
