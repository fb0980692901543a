"""Text-to-facts analytics as Spark DataFrame plans."""
