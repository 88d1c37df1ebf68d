"""All queries over the driver's own tables."""

from __future__ import annotations

from fieldloom.plans import extras, flows, grids, more, stages, texts
from fieldloom.plans.grids import observation_cube_stats

QUERIES = {**grids.query.queries, **stages.query.queries, **texts.query.queries, **extras.query.queries, **flows.query.queries, **more.query.queries}
SQL = {**grids.query.sql, **stages.query.sql, **texts.query.sql, **extras.query.sql, **flows.query.sql, **more.query.sql}

__all__ = ["QUERIES", "SQL", "observation_cube_stats"]
