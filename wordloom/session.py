"""Session helpers: a local session for tests and benchmarks, and durable intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
INPUT_PARTITIONS_CONF = "spark.wordloom.inputPartitions"


def local_session(app_name: str = "wordloom", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session. Library code never calls this; a cluster brings its own session.

    It has a folder of its own for written tables (``drop_tables`` empties it), and deals the rows of
    small input files to all cores.
    """
    number = int(cores) if cores.isdigit() else os.cpu_count() or 1
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config(CHECKPOINT_CONF, tempfile.mkdtemp(prefix="wordloom-"))
        .config(INPUT_PARTITIONS_CONF, str(number))
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may go without the setting: it then gets a fresh temporary folder.
    """
    context = spark.sparkContext
    base = spark.conf.get(CHECKPOINT_CONF, None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="wordloom-"))
        base = context.getCheckpointDir()
    return f"{base.rstrip('/')}/wordloom-{context.applicationId}"


_RECORDS: list[list[str]] = []


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths that are given out inside, for ``drop_paths`` when nothing reads them any more."""
    _RECORDS.append([])
    try:
        yield _RECORDS[-1]
    finally:
        _RECORDS.pop()


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _RECORDS:
        _RECORDS[-1].append(path)
    return path


def durable(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage, freezes anything that depends on the partitioning, and survives lost
    executors. The reader then also knows the true size, so Spark's own size check decides
    about broadcasting.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(
    df: DataFrame, columns: list[str], name: str = "buckets", partition_by: str | None = None, placed: bool = False
) -> DataFrame:
    """Write ``df`` as a table bucketed by ``columns`` in the shared folder and read it back.

    Joins and groupings on exactly these columns then leave the table where it is; only the other
    side is shuffled. There are as many buckets as shuffle partitions, one file each. ``placed`` says
    that the rows lie by these columns already.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = new_path(spark, name)
    table = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    writer = (df if placed else df.repartition(buckets, *columns)).write.bucketBy(buckets, *columns).sortBy(*columns)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.option("path", path).saveAsTable(table)
    return spark.table(table)


def drop_tables(spark: SparkSession) -> None:
    """Delete every table that this application has written to the shared folder."""
    drop_paths(spark, [shared_dir(spark)])


def drop_paths(spark: SparkSession, paths: list[str]) -> None:
    for name in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal a small input to ``spark.wordloom.inputPartitions`` partitions, where a session sets that.

    Only ``local_session`` does: its input files have too few row groups to occupy all cores. Without
    the setting, as on a cluster, the scan's own splits stay and nothing is shuffled.
    """
    partitions = df.sparkSession.conf.get(INPUT_PARTITIONS_CONF, None)
    return df.repartition(int(partitions), *keys) if partitions else df
