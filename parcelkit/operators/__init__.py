"""DataFrame operators: key enforcement, per-account rollups, exact percentile."""
