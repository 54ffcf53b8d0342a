"""Wide-column (sparse, versioned cell) analytics as Spark DataFrame jobs."""
