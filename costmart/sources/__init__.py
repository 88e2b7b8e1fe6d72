"""Readers, type conformance and writers."""
