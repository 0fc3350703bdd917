"""Tables written between the rounds of an iterative job.

Writing a round to the shared checkpoint folder cuts the lineage, survives the loss of
executors, and gives the next round a scan whose size Catalyst knows.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or the one set on the context.

    Only a local master may fall back to a temporary folder of the machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="millrace-")
    spark.sparkContext.setCheckpointDir(root)
    return root


class Scratch:
    """One fresh folder per job. Results read from it, so it stays until they are stored elsewhere;
    then ``release`` removes it, or ``release_all`` every folder this process has opened."""

    opened: list[Scratch] = []

    def __init__(self, spark: SparkSession, label: str = "job"):
        self.spark = spark
        self.path = f"{checkpoint_root(spark)}/millrace/{label}-{uuid.uuid4().hex}"
        Scratch.opened.append(self)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        where = f"{self.path}/{name}"
        df.write.mode("overwrite").parquet(where)
        return self.spark.read.schema(df.schema).parquet(where)

    def keep_only(self, *names: str) -> None:
        """Remove all tables of the folder but these; nothing that is still read may depend on the others."""
        files, target = self._folder()
        if files.exists(target):
            for found in files.listStatus(target):
                if found.getPath().getName() not in names:
                    files.delete(found.getPath(), True)

    def mounted(self) -> str | None:
        """The folder as a path of the machines' own file systems, if it is one."""
        files, target = self._folder()
        return target.toUri().getPath() if files.getUri().getScheme() == "file" else None

    def release(self) -> None:
        if self in Scratch.opened:
            Scratch.opened.remove(self)
        files, target = self._folder()
        files.delete(target, True)

    def _folder(self):
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()), target


def release_all() -> None:
    for scratch in list(Scratch.opened):
        scratch.release()
