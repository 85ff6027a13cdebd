"""Readers, schemas, lookups, the TPC-H adapter and the sinks."""
