"""The engine's operators as queries over the test tables, and the SQL that gives the same answers."""
