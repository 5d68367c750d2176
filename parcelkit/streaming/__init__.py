"""Incremental (streaming) loading of new yearly drops."""
