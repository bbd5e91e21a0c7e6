from regiolume.catalog import (  # noqa: F401  (each module registers its queries)
    aggregates,
    dashboard,
    filters,
    jobs_market,
    jobs_people,
    jobs_travel,
    joins,
    projections,
    scalars,
    series,
    sources,
)
from regiolume.catalog.registry import ENTRIES, Tables

__all__ = ["ENTRIES", "Tables"]
