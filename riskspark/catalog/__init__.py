"""Registered queries and their SQL oracles, one key per operator."""

from riskspark.catalog.registry import oracles, queries

__all__ = ["oracles", "queries"]
