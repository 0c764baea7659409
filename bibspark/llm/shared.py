"""Tables between the stages of an operator, in the shared folder of the session."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a temporary one only for a local session without it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


class Stages:
    """Tables written by one run of an operator, each dropped as soon as its readers are done."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


    def release(self) -> None:
        """Let go of the shuffle files of finished jobs: Spark removes them with the driver's objects that stand for them."""
        gc.collect()
        time.sleep(1)  # the driver's Python lets go of its Java objects a little later
        self.spark._jvm.System.gc()


def crc_of_id(column: str = "doc_id") -> Column:
    """crc32 of an id written as text; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def split_by(column: Column, divisor: int, held: int) -> Column:
    """Whether a row is held out; a null id is never held out."""
    return F.coalesce(column % divisor == held, F.lit(False))


def packed(docs: DataFrame) -> Column:
    """All columns of a table as one struct ``_row``, so that their names, whatever they are, clash with nothing."""
    return F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)]).alias("_row")


def unpacked(docs: DataFrame, **new: Column) -> list[Column]:
    """The columns of ``docs`` from its rows as packed; those given by name are new."""
    return [new.get(c, F.col("_row").getField(f"c{k}")).alias(c) for k, c in enumerate(docs.columns)]


Table = Callable[[SparkSession, str], DataFrame]


def table(name: str) -> Table:
    return lambda spark, sf_dir: spark.read.parquet(f"{sf_dir}/{name}.parquet")


documents, pages, benchmark, embeddings = table("documents"), table("pages"), table("benchmark"), table("embeddings")
