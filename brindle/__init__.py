"""Reusable DataFrame operators for text, graph, classification, relational and stream jobs."""
