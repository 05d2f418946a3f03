"""URL-inventory change analytics as Spark DataFrame operators."""
