"""Pipelines, named queries and their SQL oracles."""
