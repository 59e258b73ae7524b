"""Tables written between steps, so that iterations keep a short lineage.

Stages live under the shared folder named by ``spark.checkpoint.dir``, or else
under the session's warehouse, which is shared wherever a cluster is set up.
Written files survive the loss of executors and give the planner true sizes.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def stage_root(spark: SparkSession) -> str:
    """Shared folder for stages."""
    root = spark.sparkContext.getConf().get(_SETTING) or spark.conf.get(_SETTING, None)
    return root.rstrip("/") if root else spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_stages"


class Stages:
    """One run's stage tables, in a folder of their own."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = f"{stage_root(spark)}/{label}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as table ``name`` and return a frame that reads it."""
        target = f"{self.path}/{name}"
        df.write.parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def keyed(self, name: str, keys: list[str], schema: str, rows: int | None = None) -> KeyedTable:
        """An empty table that grows, laid out by ``keys``. ``rows``: about how many there are to begin with."""
        return KeyedTable(self, name, keys, schema, rows)

    def drop(self, *names: str) -> None:
        """Delete tables that no live frame reads any more."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


class KeyedTable:
    """A table that grows by parts, bucketed by its keys.

    A join on the keys moves the other side only. A part that is added is dealt out by the
    keys first, so it has one file per bucket, whatever number of tasks made its rows; every
    ``MERGE`` parts they are rewritten as one, so that a scan opens a bounded number of files. The catalog knows the table under a name of its
    own until :meth:`close`; the files are a stage like any other.
    """

    MERGE = 16
    #: Rows of a bucket below which a table has fewer buckets than the session has shuffle partitions.
    ROWS = 50_000

    def __init__(self, stages: Stages, name: str, keys: list[str], schema: str, rows: int | None = None):
        self.stages, self.spark, self.name, self.keys, self.schema = stages, stages.spark, name, keys, schema
        self.buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        if rows is not None:
            enough = max(self.spark.sparkContext.defaultParallelism, -(-rows // self.ROWS))
            self.buckets = min(self.buckets, enough)
        self.parts = self.version = 0

    @property
    def _label(self) -> str:
        return f"{self.name}/{self.version}"

    @property
    def _table(self) -> str:
        return "stage_" + re.sub(r"\W", "_", f"{self.stages.path.rsplit('/', 1)[-1]}_{self._label}")

    def _append(self, df: DataFrame) -> None:
        (df.repartition(self.buckets, *self.keys).write.mode("append").format("parquet").bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
         .option("path", f"{self.stages.path}/{self._label}").saveAsTable(self._table))

    def read(self) -> DataFrame:
        """All rows so far, by bucket where that serves a join."""
        return self.spark.table(self._table)

    def add(self, df: DataFrame) -> None:
        """Append rows; now and then rewrite the parts as one."""
        self._append(df)
        self.parts += 1
        if self.parts % self.MERGE == 0:
            before, table = self._label, self._table
            rows = self.read()
            self.version += 1
            self._append(rows)
            self._forget(table, before)

    def close(self) -> DataFrame:
        """Take the table out of the catalog; its rows stay readable by the returned frame."""
        self.spark.sql(f"DROP TABLE {self._table}")
        return self.spark.read.schema(self.schema).parquet(f"{self.stages.path}/{self._label}")

    def drop(self) -> None:
        """Delete the table and its files."""
        self._forget(self._table, self.name)

    def _forget(self, table: str, label: str) -> None:
        self.spark.sql(f"DROP TABLE {table}")
        self.stages.drop(label)
