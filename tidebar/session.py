"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "tidebar", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the plans rely on; `conf` keys use `__` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Zone-less texts and NTZ values are UTC; casts of both follow the session zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@contextmanager
def utc(spark: SparkSession):
    """The UTC session zone while the block runs; then the zone of before."""
    name = "spark.sql.session.timeZone"
    before = spark.conf.get(name)
    spark.conf.set(name, "UTC")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by `spark.checkpoint.dir`.

    Only when the session leaves it unset (tests, local runs) is one made here.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="tidebar-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/tidebar/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write `df` to `path` and read it back: computed once, safe from executor loss."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of this run's own scratch data."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(target, True)
