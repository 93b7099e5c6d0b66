"""Structured Streaming recommender (S5-S8, R1-R7, A10, C9-C11)."""
