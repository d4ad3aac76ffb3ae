"""Bindings to the driver's tables, the registered queries and their SQL oracles."""

from mentionlake.plans import candidates, corpus, tables, threads, universe  # noqa: F401
from mentionlake.plans.registry import QUERIES

__all__ = ["QUERIES"]
