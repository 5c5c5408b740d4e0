"""Readers, declared schemas, the written-table cache and sinks."""
