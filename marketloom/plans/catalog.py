"""All pipelines of a marketplace."""

from __future__ import annotations

from marketloom.plans.flat_feeds import flat_feeds
from marketloom.plans.nested_feeds import nested_feeds
from marketloom.plans.spec import FeedSpec


def catalog(marketplace: str = "Mkt") -> dict[str, FeedSpec]:
    """Pipelines by name. ``marketplace`` is the word that raw table names carry before
    the feed name (any case) and settlement column names carry as their prefix."""
    specs = flat_feeds(marketplace.lower(), marketplace) + nested_feeds(marketplace.lower())
    return {spec.name: spec for spec in sorted(specs, key=lambda spec: spec.name)}
