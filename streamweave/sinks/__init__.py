"""Sinks: console/memory, Kafka rows, keyed upsert, document rows, JDBC."""
