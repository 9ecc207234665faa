"""Readers, cleaning steps and month-partitioned sinks."""
