"""Batch- and stream-agnostic DataFrame operators."""
