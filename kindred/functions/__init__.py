"""Part of Kindred."""
