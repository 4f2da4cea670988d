"""Marketing and revenue analytics as Spark DataFrame operators."""
