"""The operators run over the given tables, each next to the SQL that must give the same rows."""
