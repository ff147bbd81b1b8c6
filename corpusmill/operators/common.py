"""Helpers of the operators."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpointed(df: DataFrame, looped: bool = False) -> DataFrame:
    """``df`` cut from its lineage by a reliable checkpoint in the session's shared folder.

    Where ``spark.checkpoint.dir`` names none, a temporary one is made on a single machine, as in tests; a
    cluster must name one. A checkpoint inherits the size the optimizer has estimated, which multiplies with
    each join of a loop that goes on from its last checkpoint; with ``looped`` the rows are written as a table in
    the same folder and read back, so their size is known.
    """
    folder = _shared_folder(df.sparkSession)
    if not looped:
        return df.checkpoint(eager=True)
    path = f"{folder}/{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, set if it isn't yet."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder and not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="corpusmill-"))
    return context._jsc.sc().getCheckpointDir().get()


class Tables:
    """Named tables of one run in the session's shared folder, each removed as soon as another takes its name or it is dropped.

    What was shuffled to make a table is released with it: else Spark keeps those files until the driver
    happens to collect its garbage.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.folder, self.at = spark, f"{_shared_folder(spark)}/{uuid.uuid4()}", {}

    def put(self, name: str, df: DataFrame) -> DataFrame:
        """``df`` written and read back; it may read the table that had the name before."""
        path = f"{self.folder}/{uuid.uuid4()}"
        df.write.option("compression", "zstd").parquet(path)
        self.drop(name)
        self.at[name] = (path, df.schema)
        release(self.spark)
        return self.get(name)

    def add(self, name: str, df: DataFrame) -> DataFrame:
        """The table with the rows of ``df`` appended; ``df`` mustn't read it."""
        if name not in self.at:
            return self.put(name, df)
        df.write.option("compression", "zstd").mode("append").parquet(self.at[name][0])
        release(self.spark)
        return self.get(name)

    def get(self, name: str) -> DataFrame:
        path, schema = self.at[name]
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self.at:
                path = self.spark._jvm.org.apache.hadoop.fs.Path(self.at.pop(name)[0])
                path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files that no frame refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores if it is read in fewer partitions, as a single small file is; else unchanged.

    Many files of a large table already are many partitions, so nothing is shuffled there. What comes from a
    shuffle is left alone: asking for its partitions would run it.
    """
    if df.isStreaming or "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
