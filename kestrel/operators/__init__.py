"""Relational, ordering, sampling, feature, model and evaluation operators."""
