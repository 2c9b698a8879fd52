"""Sinks and load audits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full refresh."""
    _by_period(df, partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    _by_period(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def reload_periods(
    df: DataFrame,
    path: str,
    periods: Sequence[Sequence[object]],
    partition_by: Sequence[str] = ("ano", "mes"),
) -> None:
    """Replace the listed periods by their rows in ``df``; a listed period without rows becomes empty.

    Rows of other periods are left out. The rows are written before the folders of emptied periods
    go, so a run that dies in between keeps old rows at most, and running it again finishes it.
    """
    spark, names = df.sparkSession, list(partition_by)
    wanted = spark.createDataFrame([tuple(p) for p in periods], T.StructType([df.schema[n] for n in names]))
    kept = df.join(F.broadcast(wanted), names, "left_semi")  # one row per listed period
    replace_periods(kept, path, names)
    filled = {tuple(r) for r in kept.select(*names).distinct().collect()}  # at most the listed periods
    for period in periods:
        if tuple(period) not in filled:
            folder = "/".join(f"{n}={v}" for n, v in zip(names, period, strict=True))
            place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}")
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def land_period_files(
    df: DataFrame, path: str, name: str, stamp: str, partition_by: Sequence[str] = ("ano", "mes")
) -> None:
    """One landing per period and load: ``path/name-stamp/ano=../mes=..`` with one file each.

    Loads stand side by side, so a later one never overwrites what an earlier one landed; a load of
    the same stamp does.
    """
    one = df.repartition(*[F.col(c) for c in partition_by])
    one.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(
        f"{path}/{name}-{stamp}"
    )


def replace_periods(df: DataFrame, path: str, partition_by: Sequence[str] = ("ano", "mes")) -> None:
    """Replace exactly the periods that occur in ``df``; leave all other folders alone."""
    (
        _by_period(df, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def _by_period(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Few files per period. REBALANCE lets Spark split a large period over several tasks."""
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def export_csv(
    df: DataFrame, path: str, order_by: Sequence[Column] = (), sep: str = ","
) -> None:
    """Listing with header; sorted across the files in name order. See ``readers.listing_rows``."""
    ordered = df.orderBy(*order_by) if order_by else df
    ordered.write.mode("overwrite").csv(path, header=True, sep=sep)


def land_csv(
    spark: SparkSession, source: str, target: str, schema: T.StructType, sep: str = ";"
) -> DataFrame:
    """Delimited file to Parquet: exact duplicates removed, dots in names become underscores."""
    rows = spark.read.schema(schema).csv(source, sep=sep, header=True).dropDuplicates()
    named = rows.withColumnsRenamed({c: c.replace(".", "_") for c in rows.columns})
    named.write.mode("overwrite").parquet(target)
    return spark.read.schema(named.schema).parquet(target)


def rows_per_file(df: DataFrame) -> DataFrame:
    """Load audit of a file scan: rows per file."""
    return df.groupBy(F.col("_metadata.file_path").alias("arquivo")).agg(
        F.count(F.lit(1)).alias("linhas")
    )


def rows_per_period(df: DataFrame, by: Sequence[str] = ("ano", "mes")) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("linhas"))


def compare_periods(
    before: DataFrame, after: DataFrame, by: Sequence[str] = ("ano", "mes")
) -> DataFrame:
    """Rows per period before and after a load, with the difference."""
    old = rows_per_period(before, by).withColumnRenamed("linhas", "antes")
    new = rows_per_period(after, by).withColumnRenamed("linhas", "depois")
    return old.join(new, list(by), "full").select(
        *by,
        F.coalesce("antes", F.lit(0)).alias("antes"),
        F.coalesce("depois", F.lit(0)).alias("depois"),
        (F.coalesce("depois", F.lit(0)) - F.coalesce("antes", F.lit(0))).alias("diferenca"),
    )
