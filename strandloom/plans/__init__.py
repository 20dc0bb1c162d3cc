"""Registered queries; importing this package registers all of them."""

from . import catalog, further, more

__all__ = ["catalog", "further", "more"]
