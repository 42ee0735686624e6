"""Semantic data integration, object-graph analytics and search as DataFrame programs."""
