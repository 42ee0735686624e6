"""Streaming counterparts: raw pages cleaned as they arrive and merged into objects."""
