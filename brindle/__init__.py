"""Event, customer and model analytics as Spark jobs."""
