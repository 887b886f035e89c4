"""Pipelines and the registered queries."""
