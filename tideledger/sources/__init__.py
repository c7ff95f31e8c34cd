"""Readers, JSON document flatteners, sinks and incremental loads."""
