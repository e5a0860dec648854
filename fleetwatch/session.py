"""Session settings the library relies on, and the shared folder for tables it must write."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """All instants are UTC, the last of two equal JSON keys wins, and joins broadcast by measured sizes only.

    A size estimated before the run takes no account of rows that an explode makes, nor of compression: millions of rules
    derived from a small file would be collected by the driver. So joins are planned as sort-merge joins; a side that its
    finished shuffle shows to be below the session's threshold is broadcast all the same.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    estimated, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    threshold = spark.conf.get(estimated)
    if not threshold.startswith("-"):
        spark.conf.set(measured, spark.conf.get(measured, None) or threshold)
        spark.conf.set(estimated, "-1")
    return spark


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the cluster's checkpoint folder.

    Only a local session that names no such folder falls back to a temporary one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="fleetwatch-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def kept(rows: DataFrame, name: str) -> DataFrame:
    """Rows written below the shared scratch folder and read from there: computed once, however often they are used."""
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
