"""Coloured-text document analytics on Spark."""
