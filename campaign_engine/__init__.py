"""Customer-campaign analytics as Spark jobs."""
