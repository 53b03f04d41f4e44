"""Session defaults for local use; on a cluster the session that is given is used as it is."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def local_session(cpus: int = 8, partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("glossmill")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, so that Python stages import it there."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="glossmill-")
    target = os.path.join(folder, "glossmill_src.zip")
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share, below spark.checkpoint.dir; a local session without that setting gets a
    temporary one, on a cluster its absence is an error."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        top = tempfile.mkdtemp(prefix="glossmill-work-")
    return f"{top.removeprefix('file://').rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, *keys) -> DataFrame:
    """df dealt out by keys to as many tasks as shuffles have, three for each core at least. For rows that cost more than
    their bytes say, such as files to write or segments to see: a small table is often one split, and adaptive execution would
    make few tasks of few bytes."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism), *keys)
