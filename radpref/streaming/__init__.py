"""Continuous curation."""
