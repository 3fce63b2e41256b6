"""Operators for text corpora: scans, filters, near-copies, tokens and models. Nothing outside imports this package."""
