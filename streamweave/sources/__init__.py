"""Sources: in-memory collections, text files, line parsers, CSV tables,
generated readings, Kafka and socket streams, and the test-data views."""
