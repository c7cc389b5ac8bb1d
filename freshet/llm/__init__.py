"""Operators for preparing training data: filtering, deduplication, decontamination, tokens, archives."""
