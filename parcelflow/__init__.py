"""Listing intake and enrichment as DataFrame-to-DataFrame steps on Spark."""
