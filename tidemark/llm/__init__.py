"""Operators over text corpora: filtering, deduplication, tokenisation, decontamination."""
