"""Incremental delivery with a ledger."""
