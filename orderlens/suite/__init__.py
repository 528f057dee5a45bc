"""The registered queries; importing this package registers all of them."""

from orderlens.suite import (  # noqa: F401
    feeds_suite,
    metrics_suite,
    nudges_suite,
    quality_suite,
    relational_suite,
    scalar_suite,
    streaming_suite,
    views_suite,
    writes_suite,
)
from orderlens.suite.registry import oracle_sql, queries

__all__ = ["queries", "oracle_sql"]
