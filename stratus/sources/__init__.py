"""Readers and writers: Parquet/JSON files, and Kafka behind the same calls."""
