"""Session helpers shared by every job."""

from __future__ import annotations

import os
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(master: str | None = None, partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with UTC clocks and adaptive execution; other settings come from `conf`."""
    root = str(Path(__file__).resolve().parent.parent)
    if root not in os.environ.get("PYTHONPATH", "").split(os.pathsep):  # Python workers need this package too
        os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [root, os.environ.get("PYTHONPATH")]))
    builder = SparkSession.builder.appName("harvestry")
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    builder = builder.config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`, set as the session's. Only a local master gets one of its own if that is unset."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))
    return context._jsc.sc().getCheckpointDir().get()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage in the shared folder of `spark.checkpoint.dir`; survives the loss of executors."""
    _shared_folder(df.sparkSession)
    return df.checkpoint()


def new_folder(spark: SparkSession) -> str:
    """A new path in the shared folder."""
    return f"{_shared_folder(spark)}/{uuid.uuid4().hex}"


def written(df: DataFrame, by: list[str]) -> DataFrame:
    """`df` written to the shared folder, in directories `by` these columns, and read again."""
    folder = new_folder(df.sparkSession)
    df.write.partitionBy(*by).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def filled(column: Column | str, dash: bool = True) -> Column:
    """The value, or null where null, blank or `-` says that nothing is there."""
    c = F.col(column) if isinstance(column, str) else column
    c = F.when(F.trim(c) != "", c)
    return F.when(F.trim(c) != "-", c) if dash else c


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that `df` doesn't use yet."""
    taken = {c.lower() for c in df.columns}
    name = wanted
    while name.lower() in taken:
        name = f"_{name}"
    return name


def computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """`df` with `columns` computed once a row.

    A one-row generator keeps the optimizer from inlining long expressions into every later use and filter, which
    would repeat their work and outgrow the limits of generated code.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def spread(df: DataFrame) -> DataFrame:
    """`df` in at least as many partitions as there are cores, for steps that compute much on each row."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)
