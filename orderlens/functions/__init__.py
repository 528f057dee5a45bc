"""Column helpers shared by all jobs."""

from orderlens.functions.columns import (
    boundaries,
    dbl,
    hour_floor,
    json_text,
    mean,
    money,
    ntz,
    pct,
    ratio,
    time_floor,
)

__all__ = [
    "boundaries",
    "dbl",
    "hour_floor",
    "json_text",
    "mean",
    "money",
    "ntz",
    "pct",
    "ratio",
    "time_floor",
]
