"""A folder of cleaned tables, bucketed by account.

Per-account tables are written with ``bucketBy(n, "acct")`` as
catalogue tables over a path in a shared folder. Every rollup then groups a
bucketed scan by ``acct`` and every view joins on ``acct`` with the same bucket
count, so the flagship view plans without a shuffle of the large tables
(lookups are broadcast by size). Writing the tables also cuts lineage: a lost
executor recomputes from these files, not from the raw text.

Choose ``buckets`` so one bucket of the largest table is a few hundred MB
(e.g. thousands at county-history scale); it must be the same for all tables.
The count is recorded beside each table, and ``attach`` declares that count.

Skew: a bucketed scan reads one bucket in one task, so an account holding a
large share of a table would put that share on one core. Write such a table
with ``bucketed=False``: its scans split evenly, partial aggregation combines
the hot account inside each task, and AQE's skew handling covers the joins.
``bucket_share`` measures the largest bucket of a table beforehand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "acct"


class TableStore:
    """``name -> DataFrame`` over tables written under ``location``."""

    def __init__(self, spark: SparkSession, location: str, database: str = "parcelkit_store", buckets: int = 16):
        self.spark, self.location, self.database, self.buckets = spark, location.rstrip("/"), database, buckets
        # the catalogue database lives in the store's (shared) folder, not in a local warehouse dir
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.location}/_catalog'")
        self._override: dict[str, DataFrame] = {}

    def bucket_share(self, df: DataFrame) -> float:
        """Rows of the largest bucket of ``df``, as a multiple of an even share (one pass, ``buckets`` rows)."""
        per_bucket = (df.groupBy(F.pmod(F.hash(F.col(KEY)), F.lit(self.buckets)).alias("b"))
                        .agg(F.count(F.lit(1)).alias("n")).agg(F.max("n"), F.sum("n")).first())
        return per_bucket[0] * self.buckets / per_bucket[1] if per_bucket[1] else 0.0

    def write(self, name: str, df: DataFrame, bucketed: bool = True) -> None:
        """Write a table; one without ``acct`` is never bucketed."""
        bucketed = bucketed and KEY in df.columns
        w = df.write.mode("overwrite").option("path", f"{self.location}/{name}")
        if bucketed:
            # no sortBy: scans do not report in-bucket order by default, so sorting would only cost writes
            w = w.bucketBy(self.buckets, KEY)
        w.saveAsTable(f"{self.database}.{name}")
        path, fs = self._fs(f"{self.location}/{name}/_buckets-{self.buckets if bucketed else 0}")
        fs.create(path, True).close()      # a hidden marker file, ignored by readers

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _written_buckets(self, name: str) -> int:
        """The bucket count recorded when the table was written (0: not bucketed)."""
        path, fs = self._fs(f"{self.location}/{name}/_buckets-*")
        found = [f.getPath().getName() for f in fs.globStatus(path)]
        if len(found) != 1:
            raise ValueError(f"{self.location}/{name}: expected one bucket marker, found {found}")
        return int(found[0].rpartition("-")[2])

    def write_all(self, tables, names, parallel: int = 4) -> None:
        """Write several tables; independent write jobs are submitted from ``parallel`` driver threads
        so small tables do not wait for each other (Spark schedules concurrent jobs)."""
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            for f in [pool.submit(self.write, n, tables[n]) for n in names]:
                f.result()

    def attach(self, name: str, bucketed: bool = True) -> None:
        """Register a table written earlier (e.g. by the load job) in this application's catalogue.

        A session without a shared metastore does not know the bucket spec of
        files written by another application. It is declared again here, with
        the count found beside the data, whatever this store's own ``buckets``:
        a wrong count would make bucketed scans miss rows.
        """
        path = f"{self.location}/{name}"
        schema = self.spark.read.parquet(path).schema  # footer metadata only
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        count = self._written_buckets(name) if bucketed else 0
        clustered = f" CLUSTERED BY ({KEY}) INTO {count} BUCKETS" if count else ""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.database}.{name}")
        self.spark.sql(f"CREATE TABLE {self.database}.{name} ({cols}) USING parquet{clustered} LOCATION '{path}'")

    def __getitem__(self, name: str) -> DataFrame:
        if name in self._override:
            return self._override[name]
        return self.spark.table(f"{self.database}.{name}")

    def __contains__(self, name: str) -> bool:
        return name in self._override or self.spark.catalog.tableExists(f"{self.database}.{name}")

    def with_table(self, name: str, df: DataFrame) -> "TableStore":
        other = TableStore.__new__(TableStore)
        other.__dict__.update(self.__dict__)
        other._override = dict(self._override)
        other._override[name] = df
        return other
