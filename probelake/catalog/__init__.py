"""The registered queries over the driver tables, and their SQL counterparts."""

from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
