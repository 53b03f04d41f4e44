"""Tables in the folder that driver and executors share.

A written table cuts lineage: what comes after it survives the loss of executors without going back to the input, and
row numbers given before the write stay as they are. The tables of one run of an operator belong to a ``Run``; runs don't
know of each other, so that any number of them can go on in one process.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark's own switch for dropping the shuffle files of a query when it has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where none is set, a local session gets a temporary one; on a cluster that would be
    another disk on each machine, so it is an error there."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if context.applicationId not in _LOCAL:
            _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="glossmill-shared-")
        folder = _LOCAL[context.applicationId]
    return folder.rstrip("/")


class Run:
    """The written tables of one run, in a folder of their own."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write df as Parquet and read it again. The shuffle files of the write go when it has ended."""
        path = f"{self.folder}/{name}-{uuid.uuid4().hex[:12]}"
        before = self.spark.conf.get(_CLEANUP, None)
        self.spark.conf.set(_CLEANUP, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(_CLEANUP)
            else:
                self.spark.conf.set(_CLEANUP, before)
        table = self.spark.read.schema(df.schema).parquet(path)
        table.scratch_path = path
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that nothing reads any more."""
        for table in tables:
            self._delete(table.scratch_path)

    def delete(self) -> None:
        """Delete all tables of the run; nothing may read them any more."""
        self._delete(self.folder)

    def _delete(self, path: str) -> None:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """One table in a run of its own."""
    return Run(df.sparkSession).keep(df, name)


def shielded(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """df with its columns called c0, c1, ..., so that no name of theirs meets one of an operator's; and their own names."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns)))), df.columns
