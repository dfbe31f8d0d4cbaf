"""Named queries over the given tables, each with its SQL twin where SQL can say it."""

from tradepulse.catalog import (  # noqa: F401
    aggregates, etl, jobs, joining, live, scalars, sinks, sources, states, streams,
)
from tradepulse.catalog.registry import ORACLE, QUERIES  # noqa: F401
