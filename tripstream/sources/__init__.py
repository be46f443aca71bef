"""Sources: Kafka-shaped message feeds, Kafka / file streams, tables."""
