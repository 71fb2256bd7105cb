"""Operators for building training corpora: cleaning, deduplication, mixing and tokenizing."""
