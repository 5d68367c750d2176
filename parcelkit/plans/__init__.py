"""Query plans: views, data-quality checks, reports, table loader, read-only SQL."""
