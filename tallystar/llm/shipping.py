"""Sending the package to Python workers: see ``tallystar.shipping``."""

from tallystar.shipping import reachable, ship_package

__all__ = ["reachable", "ship_package"]
