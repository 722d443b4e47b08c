"""Intermediate tables in the cluster's shared folder.

Cutting lineage through a written table survives the loss of any executor, and later passes read
only the columns they need.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; for a local session without it, one that goes when it ends."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="riskrank-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.sparkContext.setCheckpointDir(folder)
    return folder


class Workspace:
    """A private subfolder for intermediate tables; call ``clear`` once their readers are done."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark).rstrip('/')}/riskrank-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}-{uuid.uuid4().hex[:8]}"

    def keep(self, df: DataFrame, name: str = "table") -> DataFrame:
        """Write ``df`` as Parquet and return a reader of the written table."""
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def with_row_id(self, df: DataFrame, name: str = "row_id") -> DataFrame:
        """Number the rows of a table that has no unique column, and fix the numbers by writing them.

        The numbers are unique and follow the input order within each partition; they are not
        consecutive across partitions.
        """
        return self.keep(df.withColumn(name, F.monotonically_increasing_id()), "numbered")

    def clear(self) -> None:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
