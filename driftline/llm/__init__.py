"""Operators over text for training data: quality, packing, dedup, chat, BPE, fingerprints, LM, toxicity, secrets, licenses."""
