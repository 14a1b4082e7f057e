"""Tables of a run that several later steps read: computed once, written to the shared folder, read back."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: How Parquet files are about as large as their rows.
PLAIN = {"compression": "none", "parquet.enable.dictionary": "false"}

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where that is unset, a folder of this process, if all runs in it."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if "dir" not in _own:
        _own["dir"] = (keep := tempfile.TemporaryDirectory(prefix="tidewire-")).name
        atexit.register(keep.cleanup)
    return f"file://{_own['dir']}"


def staged(df: DataFrame, label: str, packed: bool = False) -> DataFrame:
    """``df``, written as Parquet and read back: cuts the lineage, survives lost executors, has a known size.

    Spark takes the files' size for that of the rows and sends tables that seem small to the driver and every task, so
    the files are written plainly: packed ones hold ten and more times as many bytes. ``packed`` is for tables that joins with a hint read.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    (df.write if packed else df.write.options(**PLAIN)).parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)
