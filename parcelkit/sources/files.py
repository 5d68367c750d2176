"""Opening files from Python tasks, by the paths that Spark lists."""

from __future__ import annotations

from urllib.parse import quote

# --- fixed values: schemes that Arrow's file systems open ------------------------
ARROW_SCHEMES = ("", "file", "hdfs", "s3", "gs", "gcs", "abfs", "abfss")


def scheme(path: str) -> str:
    return path.partition(":")[0].lower() if ":" in path.split("/")[0] else ""


def openable(path: str) -> bool:
    """Whether a task can open ``path`` itself (else only Spark's readers can)."""
    return scheme(path) in ARROW_SCHEMES


def filesystem(path: str):
    """(Arrow file system, path in it) of a path as Spark lists it: local ones may hold any character."""
    from pyarrow import fs as pafs
    if scheme(path) in ("", "file"):
        name = path[5:] if path.startswith("file:") else path
        return pafs.LocalFileSystem(), "/" + name.lstrip("/") if path.startswith("file:") else name
    return pafs.FileSystem.from_uri(quote(path, safe=":/@%"))
