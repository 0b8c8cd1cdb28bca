"""The marts and panels as temporary views, for ``SELECT * FROM panel_x``."""

from __future__ import annotations

from pyspark.sql import DataFrame

from driftlake.functions.clock import Clock
from driftlake.plans.marts import MARTS, Tables
from driftlake.plans.panels import PANELS


def register_views(tables: Tables, as_of: Clock = None) -> list[str]:
    """Create one view per lake table, mart and panel; returns their names."""
    made: dict[str, DataFrame] = {name: tables[name] for name in tables}
    for name, build in {**MARTS, **PANELS}.items():
        made[name] = build(tables, as_of)
    for name, df in made.items():
        df.createOrReplaceTempView(name)
    return list(made)
