"""Shared pieces: table access, scratch tables and the word definition."""

from __future__ import annotations

import atexit
import tempfile
import uuid

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the contracts: ASCII white space and words between it.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"

_own_dir: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a folder of this process only where that is unset and all runs in one process."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared:
        return shared.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if "dir" not in _own_dir:
        _own_dir["dir"] = (keep := tempfile.TemporaryDirectory(prefix="tidewire-")).name
        atexit.register(keep.cleanup)
    return f"file://{_own_dir['dir']}"


def scratch(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage like a checkpoint, survives lost executors, and gives the next step a
    plain scan: both sides of a later join get fresh exchanges, so that adaptive execution can
    split hot keys.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)  # goes with the application, if not before
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def _from_files(df: DataFrame) -> bool:
    """Whether rows come one by one from files, so that file and place name them."""
    nodes = [line.lstrip(" :+-").split(" ")[0] for line in df._jdf.queryExecution().analyzed().toString().splitlines()]
    return set(nodes) <= {"Project", "Filter", "SubqueryAlias", "Relation"} and nodes.count("Relation") == 1 and "Relation" in nodes[-1:]


def placed(df: DataFrame, label: str) -> DataFrame:
    """As ``numbered``, by two numbers that cost little: ``at_file``, a hash of the file's path, and ``at_row``."""
    if _from_files(df):
        try:
            return df.select("*", F.xxhash64("_metadata.file_path").alias("at_file"), F.col("_metadata.row_index").alias("at_row"))
        except AnalysisException:  # files of another format
            pass
    return scratch(df.withColumns({"at_file": F.lit(0).cast("long"), "at_row": F.monotonically_increasing_id()}), label)


def numbered(df: DataFrame, label: str) -> DataFrame:
    """``df`` with ``rid``, a number of each row that stays the same however often the plan is run.

    Rows that come one by one from files are named by their file and place, and nothing is written.
    Other rows are written once, with a running number.
    """
    if _from_files(df):
        try:
            file = F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.row_index").cast("string"))
            return df.select("*", F.unhex(F.md5(file)).alias("rid"))
        except AnalysisException:  # files of another format
            pass
    return scratch(df.withColumn("rid", F.monotonically_increasing_id()), label)


def drop_scratch(df: DataFrame) -> None:
    """Remove a scratch table that no later plan reads."""
    path = getattr(df, "_scratch_path", None)
    if path:
        jvm = df.sparkSession._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def local_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few rows of the driver as a table whose size Spark knows, so that joins with it need no shuffle."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return spark.createDataFrame(pa.table({name: pa.array(c, kinds[kind]) for (name, kind), c in zip(fields, columns)}))


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def hash_sample(df: DataFrame, key: str, rows: int, total: int | None = None) -> DataFrame:
    """The ``rows`` rows of the smallest hashes of ``key``, the same ones in every run; ``key`` must be unique.

    A first cut by the hash keeps about one and a half times as many, so that what the tasks hand
    to the final sort doesn't grow with their number.
    """
    total = df.count() if total is None else total
    share = min(1.0, (1.5 * rows + 1000) / max(1, total))
    if share < 1:
        df = df.where(F.xxhash64(key) < int(-(2**63) + share * 2**64))
    return df.orderBy(F.xxhash64(key), key).limit(rows)


def label_sample(labels: DataFrame, column: str, rows: int, where: Column | None = None) -> DataFrame:
    """At most ``rows`` labelled documents, by ``hash_sample`` of doc_id.

    A doc_id with several label rows counts once, with its largest label.
    """
    kept = labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1))
    if where is not None:
        kept = kept.where(where)
    return hash_sample(kept.groupBy("doc_id").agg(F.max(column).cast("int").alias("label")), "doc_id", rows)
