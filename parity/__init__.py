"""The operators run on the given tables, each beside the SQL that must agree with it."""
