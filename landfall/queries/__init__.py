"""One query per operator, with SQL that states the same result."""

from . import changes, cleaning, keys, loads, shaping
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "changes", "cleaning", "keys", "loads", "shaping"]
