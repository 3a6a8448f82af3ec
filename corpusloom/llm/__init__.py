"""Operators of a training-data pipeline: filters, deduplication, scores, packing and token counts."""
