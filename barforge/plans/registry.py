"""Queries of the engine's own operators, with their DuckDB counterparts."""

from __future__ import annotations

from barforge.plans import chain, evaluation, features, more, tapes

QUERIES: dict = {**tapes.QUERIES, **features.QUERIES, **evaluation.QUERIES, **more.QUERIES, **chain.QUERIES}
ORACLES: dict = {**tapes.ORACLES, **features.ORACLES, **evaluation.ORACLES, **more.ORACLES, **chain.ORACLES}
