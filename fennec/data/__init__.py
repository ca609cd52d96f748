"""Package data (fixed values)."""
