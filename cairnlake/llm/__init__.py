"""Operators of a training-data pipeline: token counts, language models, dedup, filters, packing."""
