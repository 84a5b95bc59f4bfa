"""Curation analytics on Spark: declarative operators over document-shaped records."""
