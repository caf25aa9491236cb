"""Whole queries and pipelines made of the operators."""
