"""Community discussion analytics as Spark DataFrame operators."""
