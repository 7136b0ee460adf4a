"""Customer-risk analytics as plain Spark DataFrame transformations."""
