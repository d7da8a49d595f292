"""Composite jobs: each is one lazy plan over the operators."""
