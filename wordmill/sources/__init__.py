"""Readers (S1-S9) and writers (K1-K9)."""
