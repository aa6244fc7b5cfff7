"""Sources: base tables, Kafka (live), Kafka-shaped record files, fixtures."""
