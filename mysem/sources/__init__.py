"""Reading and writing tables, delimited files and SQL dumps."""
