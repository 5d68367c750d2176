"""parcelkit — property-appraisal analytics on Spark.

Sub-packages: ``sources`` (text, codebook, archive and page readers),
``functions`` (Column helpers with the source database's semantics),
``operators`` (key enforcement, per-account rollups, exact percentile),
``plans`` (views, data-quality checks, reports, loader, read-only SQL),
``streaming`` (incremental loading of new yearly drops).
"""

__version__ = "0.1.0"
