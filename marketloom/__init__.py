"""Marketplace data unification on Spark."""

from marketloom.settings import LOOKBACK_MS, Lineage, Settings

__all__ = ["LOOKBACK_MS", "Lineage", "Settings"]
