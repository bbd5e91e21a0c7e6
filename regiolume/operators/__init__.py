from regiolume.operators import (
    aggregate,
    filters,
    joins,
    project,
    quantile,
    reshape,
    series,
    setops,
    topk,
    totals,
)

__all__ = [
    "aggregate", "filters", "joins", "project", "quantile", "reshape", "series", "setops", "topk",
    "totals",
]
