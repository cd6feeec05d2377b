"""Operators that prepare training data: near-duplicates, packing, scoring, tokens, rules, personal data and search."""
