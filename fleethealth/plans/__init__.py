"""Pipelines made of operators."""
