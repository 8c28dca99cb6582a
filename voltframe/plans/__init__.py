"""Registered queries (one per operator of the inventory) and their oracles."""

from __future__ import annotations

from . import align_q, describe_q, evaluate_q, extra_q, features, forecast_q, integrate, models_q, prepare_q, streams_q  # noqa: F401
from .registry import HEADLINE, ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES", "HEADLINE"]
