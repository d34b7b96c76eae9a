"""All queries over the test tables."""

from __future__ import annotations

from pixelloom.plans import queries_cube, queries_grid, queries_pixel, queries_polygon, queries_table, queries_warp  # noqa: F401  (they register)
from pixelloom.plans.registry import ORACLES, QUERIES


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(ORACLES)
