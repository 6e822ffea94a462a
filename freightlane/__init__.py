"""Table movement, profiling and reconciliation as Spark DataFrame jobs."""
