"""Student-outcome analytics as Spark DataFrame jobs."""
