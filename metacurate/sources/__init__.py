"""Readers for the input formats, each with an explicit schema."""
