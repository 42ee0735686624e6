"""Readers of result tables, mappings and models, and their writers."""
