"""Relational, text, graph and model-fitting operators (DataFrame in, DataFrame out)."""
