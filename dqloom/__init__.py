"""Data-quality assessment of relational tables as Spark DataFrame jobs."""
