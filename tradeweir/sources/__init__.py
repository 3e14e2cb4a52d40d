"""Readers: Kafka-shaped records, tables, snapshots, JDBC and the synthetic feed."""
