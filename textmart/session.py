"""Spark session and lineage helpers.

Every job in the package is lazy ``DataFrame -> DataFrame``; the session
settings here are the ones the jobs are tuned for (AQE with skew handling,
no UI, UTC session clock, Arrow for the few Python-worker stages).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_session(
    master: str | None = None,
    *,
    app_name: str = "textmart",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or fetch) a session configured for the textmart jobs.

    On a cluster ``master`` is left to ``spark-submit``; locally it defaults to
    ``local[N]`` where N comes from ``BENCH_CPUS`` or the core count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is None and not os.environ.get("SPARK_MASTER"):
        master = f"local[{os.environ.get('BENCH_CPUS', os.cpu_count() or 4)}]"
    if master:
        builder = builder.master(master)
    cores = int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4))
    conf = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions or max(8, 2 * cores)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("TEXTMART_DRIVER_MEMORY", "16g"),
        "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
        # a union of equally partitioned inputs keeps one partition count (avoids a zip mismatch in 4.1)
        "spark.sql.unionOutputPartitioning": "false",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in ``spark.checkpoint.dir``.

    Where the setting is absent, a folder of the warehouse is used (shared
    like the tables in it), never a machine-local temporary folder.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        path = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/textmart-checkpoints"
        spark.conf.set(CHECKPOINT_CONF, path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a table that is read in fewer partitions than there are cores to all cores.

    For work that costs more CPU than reading (tokenising): a table in one file
    of one row group would be tokenised by one task. A table with enough
    partitions, as any large one has, stays as it is read.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def cut_lineage(df: DataFrame, *, fmt: str = "parquet", schema: StructType | None = None, compression: str | None = None) -> DataFrame:
    """Materialise ``df`` once as a table in the shared checkpoint folder and read it back.

    Used for intermediates that several branches of a job consume: they are
    computed once, survive executor loss (the files are on shared storage) and
    are read back as a columnar table (column pruning, codegen), with
    ``schema`` where the reader has to know more than the files say.
    ``compression`` is that of the files (default: the session's).
    ``fmt=None`` uses ``DataFrame.checkpoint`` instead.
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark)
    if fmt is None:
        return df.checkpoint(eager=True)
    path = f"{base.rstrip('/')}/textmart-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite").format(fmt)
    (writer.option("compression", compression) if compression else writer).save(path)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema is not None else reader).load(path)
