"""Supply and contract analytics as Spark DataFrame jobs."""
