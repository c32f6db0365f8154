"""Session settings and reliable cut points.

Nothing here assumes one machine: folders that several executors must see come from
``spark.checkpoint.dir``, which a cluster points at shared storage.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators rely on. AQE splits hot join keys; the force flag keeps that
# true when a later aggregate would otherwise make Spark leave the hot partition whole. The driver keeps the
# text of every plan, with all numbers of constant tables in it, so that text is cut; the plans aren't.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.maxPlanStringLength": "100000",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Functions that run in workers are pickled by module name, so a worker that was started anywhere else
    than beside the package needs its files.
    """
    sc = spark.sparkContext
    if _SHIPPED.get("application") == sc.applicationId:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    made = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="harborline-"), "harborline"), "zip", os.path.dirname(package), os.path.basename(package)
    )
    sc.addPyFile(made)
    _SHIPPED["application"] = sc.applicationId


_SHIPPED: dict[str, str] = {}


def local_session(cores: int | str = "*", memory: str = "8g", app: str = "harborline") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see; a machine-local one is made only for a local master."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        current = sc._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return os.path.dirname(current.get())
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="harborline-")
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path for a table or file set written and read back by one query."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def drop_at_end(spark: SparkSession, path: str) -> None:
    """Delete a written table when the application ends: results that still read it come first."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from there.

    One pass writes it (an eager checkpoint computes its input twice), the files outlive lost
    executors, and later steps read only the columns they need.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "cut")
    df.write.parquet(path)
    drop_at_end(spark, path)
    return spark.read.schema(df.schema).parquet(path)
