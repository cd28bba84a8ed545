"""Operators for large text collections: dedup, packing, filtering, scans, extraction, scoring."""
