"""Inputs: table loading, Kafka-shaped records, device registry."""

from voltline.sources.tables import load_table, TABLES  # noqa: F401
