"""Commerce analytics as lazy Spark DataFrame plans."""
