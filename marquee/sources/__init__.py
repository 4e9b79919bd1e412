"""Readers, landed-payload adapters and sinks."""
