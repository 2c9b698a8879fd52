"""Tables stored in buckets by key, so that joins on the key move no rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def store(df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str) -> DataFrame:
    """Write ``df`` as table ``name`` at ``path``, one sorted file per bucket, and read it.

    Tables with equal numbers of buckets by the same key join, group and rank by it, or by it and
    more, where their rows lie. A key's rows are one task's, so choose ``buckets`` for the largest
    table and keep to ``joins.version_join`` where one key holds a large part of the rows.
    """
    keys = list(keys)
    dealt = df.repartition(buckets, *[F.col(k) for k in keys])
    writer = dealt.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", path).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def drop(spark: SparkSession, name: str) -> None:
    """Forget the table; its files stay at its path."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
