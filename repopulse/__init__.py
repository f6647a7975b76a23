"""Repository-activity analytics expressed as plain PySpark jobs."""
