"""Session settings and the shared folder for written tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "docketeer") -> SparkSession:
    """A session for tests and the local bench; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        # Lets the adaptive planner hash instead of sort where it measured small partitions.
        .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB")
        .getOrCreate()
    )


# The folders of local sessions that name none, by application.
_local_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own in /tmp.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="docketeer-", dir="/tmp")
    return _local_folders[app]


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition a table that comes in fewer splits than there are cores.

    Texts are worked on where they are read, and one small file is one task. A large
    table has more splits than that and stays as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


@contextmanager
def grouped_listings(spark: SparkSession) -> Iterator[None]:
    """Within it the paths that a reader is given are listed by a task for each core.

    Else every path is a task of its own, which takes longer than to read the file. A file stream
    lists the paths of each batch, so it should run to its end within.
    """
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(name, None)
    spark.conf.set(name, spark.sparkContext.defaultParallelism)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def settled(df: DataFrame, name: str = "settled") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage, so that lost executors cost one step only, and gives the
    planner the true size of the table.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
