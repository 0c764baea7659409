"""Session construction and the shared work folder.

Intermediate tables (numbered outputs, clustering rounds) are written as
Parquet below the folder named by ``spark.checkpoint.dir``, so they survive the
loss of executors and cut the lineage of iterative jobs.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_session(app_name: str = "bibspark", master: str | None = None, **conf) -> SparkSession:
    """Session with adaptive execution on; extra settings as keyword pairs in ``conf``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def work_folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables of this application."""
    root = spark.conf.get(_CHECKPOINT_KEY, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="bibspark-")
        spark.conf.set(_CHECKPOINT_KEY, root)
    return f"{root.rstrip('/')}/bibspark-{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the work folder once and return it as a plain table scan."""
    spark = df.sparkSession
    path = f"{work_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clear_work_folder(spark: SparkSession) -> None:
    """Drop every intermediate table of this application."""
    path = spark._jvm.org.apache.hadoop.fs.Path(work_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
