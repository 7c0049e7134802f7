"""Operators of a training-data pipeline: token counts, deduplication, decontamination, filters, encodings."""
