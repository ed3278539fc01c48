"""Session helpers: local sessions for tests, shared scratch space, lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Inputs with this many splits are large enough to be left as they are.
FEW_SPLITS = 16


def local_session(cpus: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A session for one machine.  Clusters bring their own session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tidewell")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``.  Only a local session, where
    the one machine is the whole cluster, falls back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    made = tempfile.mkdtemp(prefix="tidewell-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage and go on from there.

    Used by loops: the plan stays short and a lost executor costs one read.
    """
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def rewrite(df: DataFrame, name: str, before: str | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` below the shared folder and read it again, then drop the table at ``before``.

    For loops whose state is written anew in every step: ``df`` may read ``before``, and
    only one state remains.  Returns the frame and its path.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    if before is not None:
        drop_scratch(spark, before)
    return spark.read.schema(df.schema).parquet(path), path


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete a table that ``scratch_path`` named."""
    old = spark._jvm.org.apache.hadoop.fs.Path(path)
    old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go as soon as the table is written that they were made for.

    For loops that write every frame once; Spark otherwise keeps them until the driver collects its garbage.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores on an input of a few splits, such as one small file.

    Anything with ``FEW_SPLITS`` splits or more is returned as it is, however many cores
    there are, so the rows of a large table are never moved.
    """
    wanted = min(df.sparkSession.sparkContext.defaultParallelism, FEW_SPLITS)
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df
