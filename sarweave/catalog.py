"""All queries of the engine by name, with DuckDB SQL that gives the same rows."""

from __future__ import annotations

from sarweave.queries import ORACLES, QUERIES, composite, geo, names, qa, raster, relational  # noqa: F401

FLAGSHIP = "group_safe_splits"
