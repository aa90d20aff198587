"""Readers, writers and the customer table derived from the driver's tables."""
