"""Write an intermediate result once and read it back."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_KEY = "spark.checkpoint.dir"
_SHORT = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def working_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one in the warehouse where that is unset.

    Both are shared by all executors; nothing is written to a folder of one machine.
    """
    folder = spark.conf.get(_KEY, None) or spark.sparkContext.getConf().get(_KEY)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_work"
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{working_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of writes in here go as soon as each write is done.

    Otherwise they stay until the driver happens to collect its garbage, and a job of many steps
    holds the shuffles of all of them on disk.
    """
    before = spark.conf.get(_SHORT, None)
    spark.conf.set(_SHORT, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHORT)
        else:
            spark.conf.set(_SHORT, before)


def materialize(df: DataFrame, name: str = "step", path: str | None = None) -> DataFrame:
    """Parquet copy of ``df``: computed once, cuts lineage, survives lost executors.

    Needed where two branches must see the very same rows, such as positions from a range
    partitioning, and worth it where several branches share an expensive result. A caller that
    removes the copy when it is done names its ``path``.
    """
    spark = df.sparkSession
    path = path or new_path(spark, name)
    with short_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
