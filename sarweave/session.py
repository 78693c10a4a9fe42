"""Session construction and the shared scratch folder."""

from __future__ import annotations

import gc
import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def session(app: str = "sarweave", cpus: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benches; on a cluster the caller brings its own."""
    b = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SARWEAVE_DRIVER_MEMORY", "8g"))
    )
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    A cluster names it in spark.checkpoint.dir. Only where that is unset and all runs in one process (master
    local, as in tests) a temporary folder of our own is taken and put into the session.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is unset: a cluster needs a folder that the driver and all executors share")
        d = "file://" + tempfile.mkdtemp(prefix="sarweave-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d.rstrip("/")


def text_batches(spark: SparkSession, rows: int = 1000, size: str = "4m") -> None:
    """Hand texts to Python in Arrow batches of few rows and bytes, so that two copies of a batch stay small on both sides.

    It holds for the session from then on, since plans read it when they run; what the session sets itself is left as it is.
    """
    for key, default, value in (("maxRecordsPerBatch", "10000", str(rows)), ("maxBytesPerBatch", "67108864b", size)):
        key = f"spark.sql.execution.arrow.{key}"
        if spark.conf.get(key) == default:
            spark.conf.set(key, value)


def _scratch(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/sarweave-{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder at path, in any store that Spark reads."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def clear_scratch(spark: SparkSession) -> None:
    """Remove all tables that materialize() made for this application; results that still read them are lost."""
    _delete(spark, _scratch(spark))


class Scratch:
    """The tables that materialize() makes inside a with block; those not kept are removed at its end."""

    _open: list[Scratch] = []

    def __init__(self, spark: SparkSession):
        self.spark, self.paths, self.kept = spark, [], []

    def keep(self, df: DataFrame) -> DataFrame:
        """A table that materialize() gave; a block around this one may still remove it."""
        self.kept.append(df._sarweave_path)
        return df

    def __enter__(self) -> Scratch:
        Scratch._open.append(self)
        return self

    def __exit__(self, *error) -> None:
        Scratch._open.remove(self)
        for path in self.paths:
            if path not in self.kept:
                _delete(self.spark, path)
            elif Scratch._open:
                Scratch._open[-1].paths.append(path)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write df as Parquet below the shared folder and read it back.

    It cuts lineage as checkpoint() does, computes the rows once, and survives lost executors.
    """
    spark = df.sparkSession
    path = f"{_scratch(spark)}/{label}-{uuid.uuid4().hex}"
    if Scratch._open:
        Scratch._open[-1].paths.append(path)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._sarweave_path = path
    return out


def drop_materialized(df: DataFrame) -> None:
    """Remove the files of a table that materialize() made and that nothing reads any more."""
    spark = df.sparkSession
    for f in df.inputFiles()[:1]:
        _delete(spark, f.rsplit("/", 1)[0])


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps: it does so once nothing refers to them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
