"""Spark-native ingestion of document tables and validation of bank statements."""
