"""Every operator as a runnable query on the given tables, with its SQL twin where one exists."""

from panelwise.plans.catalog import (  # noqa: F401
    aggregates,
    forecasts,
    joins,
    models,
    scalars,
    sources,
    windows,
)
from panelwise.plans.catalog.registry import ORACLES, QUERIES  # noqa: F401
