"""Model operators on Spark ML and the public DataFrame API."""
