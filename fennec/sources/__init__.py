"""Readers, writers, the catalog view over the driver tables, fitted state."""
