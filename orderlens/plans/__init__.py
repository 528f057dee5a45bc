"""Jobs: reporting views, metrics, reports, refreshes, quality, rules."""
