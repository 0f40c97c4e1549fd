"""Queries over the generic test tables, and the SQL that checks them."""
