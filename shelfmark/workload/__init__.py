"""The operators run on the test tables, each with the SQL that gives the same result."""
