"""The registered queries of the engine with the SQL that they must agree with."""

from __future__ import annotations

from . import cohort, files, parts, readers, scores, steps, variants  # noqa: F401  (they register their queries)
from .registry import ORACLES, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
