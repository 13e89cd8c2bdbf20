"""Queries over the driver's tables, each with the SQL that must give the same rows."""
