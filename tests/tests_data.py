"""Shared fixtures as plain data."""

from test_cities import cities
from test_domain import GARAM

__all__ = ["GARAM", "cities"]
