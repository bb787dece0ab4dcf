"""Point-in-time evidence analytics as lazy Spark DataFrame operators."""
