"""The work folder that driver and executors share, and tables kept in it."""

from __future__ import annotations

import atexit
import gc
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which all executors share.

    Only where neither the configuration nor the context has one and Spark runs on
    one machine (tests) a temporary folder is made and set, and removed at exit; a
    cluster without a shared folder is an error.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get().rstrip("/")
    if not on_one_machine(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = tempfile.mkdtemp(prefix="ledgerloom-")
    atexit.register(shutil.rmtree, root, True)
    spark.sparkContext.setCheckpointDir(root)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def on_one_machine(spark: SparkSession) -> bool:
    return re.match(r"local(\[|$)", spark.sparkContext.master) is not None


def new_folder(spark: SparkSession, what: str) -> str:
    return f"{shared_root(spark)}/ledgerloom-{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage and outlives executors."""
    folder = new_folder(df.sparkSession, what)
    df.write.parquet(folder)
    let_shuffles_go(df.sparkSession)
    out = df.sparkSession.read.schema(df.schema).parquet(folder)
    out.folder = folder
    return out


def let_shuffles_go(spark: SparkSession) -> None:
    """Shuffle files of what is written by now go with the objects that own them."""
    if not on_one_machine(spark):
        gc.collect()
        spark._jvm.System.gc()


def forget(*tables: DataFrame) -> None:
    """Delete tables of written() that only tables already written depend on."""
    for t in tables:
        drop_folder(t.sparkSession, t.folder)


def drop_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame) -> DataFrame:
    """Rows that are read in fewer splits than there are cores, dealt to all cores; other inputs are read where they lie."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df
