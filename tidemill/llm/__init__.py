"""Operators of a training-data pipeline: duplicates, quality, token counts, packing, search, captures."""
