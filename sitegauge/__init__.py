"""Content and search analytics as Spark DataFrame operators."""
