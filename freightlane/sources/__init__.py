"""Table scans (files, JDBC) and the report, profile and reject sinks."""
