"""Readers, domain views over the driver tables, and sinks."""
