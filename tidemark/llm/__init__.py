"""Operators for preparing training data: deduplication, decontamination, counting, scoring, filtering, packing."""
