"""Operators for training data: tokens, quality, archives, near-duplicates, decontamination, packing, language models."""
