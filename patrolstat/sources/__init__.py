"""Readers and sinks (explicit schemas; distributed writes)."""
