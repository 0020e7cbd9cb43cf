"""Readers: explicit schemas, no inference, one scan per input."""
