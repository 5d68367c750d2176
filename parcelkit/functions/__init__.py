"""Column helpers (scalar and aggregate) with the source database's semantics."""
