"""Log movement and stream analytics written as plain Spark jobs."""
