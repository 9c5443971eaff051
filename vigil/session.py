"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "vigil", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster or `setCheckpointDir` names it.

    Only where none is set on a local master is a new local one made and kept; on a cluster that is an
    error, as each machine would write to a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize_by(df: DataFrame, keys: list[str], name: str = "step", distinct: bool = False) -> DataFrame:
    """As `materialize`, laid out by `keys`: work grouped, windowed or joined by them and more needs no shuffle.
    `distinct` leaves out rows that repeat, in the same shuffle.

    There are as many buckets as shuffle partitions, and each row is shuffled once, here. The table has a name in the
    session's catalog only while it is made; its files stay in the shared folder."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"laid_out_{uuid.uuid4().hex}"
    df = df.repartition(buckets, *keys)
    if distinct:
        df = df.distinct()
    df.write.bucketBy(buckets, *keys).option("path", new_folder(spark, name)).saveAsTable(table)
    try:
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")


def materialize(df: DataFrame, name: str = "step", folder: str | None = None) -> DataFrame:
    """`df` as a written table in the shared folder: computed once, and safe from lost executors."""
    spark = df.sparkSession
    folder = folder or new_folder(spark, name)
    df.write.mode("overwrite").parquet(folder)
    table = spark.read.schema(df.schema).parquet(folder)
    # Spark writes a file even for no rows: without one, the executors wrote somewhere else.
    if not table.inputFiles():
        raise RuntimeError(f"nothing was written to {folder}; is it shared by driver and executors?")
    return table
