"""Registered queries over the given tables, with a SQL text for each exact one."""

from catalog.oracles import ORACLES
from catalog.queries import QUERIES

__all__ = ["ORACLES", "QUERIES"]
