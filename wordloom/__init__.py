"""Text-corpus preparation and next-word models as Spark DataFrame operations."""
