"""Sales and retail-execution analytics as plain Spark jobs."""
