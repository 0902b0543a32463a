"""All registered queries (importing the query modules fills the registry)."""

from __future__ import annotations

from . import q_charts, q_exact, q_features, q_models, q_profile, q_select  # noqa: F401
from .registry import HEADLINE, ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE", "HEADLINE"]
