"""All queries of the subpackage: importing this module registers every operator."""

from __future__ import annotations

from . import (  # noqa: F401
    collocation, decontaminate, jaccard, langid, lines, mainhtml, mixing, negatives, passages, quality, tokens, toxicity, urls,
)
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
