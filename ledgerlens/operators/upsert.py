"""Update-or-insert without a table format, on Parquet folders partitioned by period.

With a catalog that supports it, ``MERGE INTO`` does the same in one statement.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.windows import latest
from ledgerlens.sources.writers import replace_periods

_PENDING = "_pending"


def merge_rows(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column] = (),
    sequence: Sequence[str] = (),
) -> DataFrame:
    """Target after the merge: a batch row replaces the row with its key or is added.

    Several batch rows of a key are reduced to the first in ``order_by``; rows that tie in it are
    told apart by a hash of the whole row, so every run picks the same one. With ``sequence`` the
    row with the highest sequence wins even if it is the stored one, which makes the result
    independent of the order in which batches arrive.
    """
    keys, columns = list(keys), target.columns
    order = [F.col(c).desc() for c in sequence] + list(order_by) + [F.xxhash64(*columns)]
    source = latest(batch.dropna(subset=keys), keys, order).select(*columns)
    if sequence:
        both = target.withColumn("_new", F.lit(0)).unionByName(source.withColumn("_new", F.lit(1)))
        return latest(both, keys, [*order, F.col("_new").desc()]).drop("_new")
    return target.join(source.select(*keys), keys, "left_anti").unionByName(source)


def upsert(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str] = ("ano", "mes"),
    order_by: Sequence[Column] = (),
    sequence: Sequence[str] = (),
) -> None:
    """Merge a batch into the table at ``path``; only touched period folders are rewritten.

    Touched are the periods of the batch and the periods where its keys are stored now, since an
    update may move a row to another period. The merged rows of all touched periods are computed
    once and written to ``_pending`` inside the table, which readers of the table skip; only then
    are the period folders replaced from there. A run that dies before ``_pending`` is complete has
    changed nothing; one that dies later leaves every row in ``_pending``, and ``recover``, which
    each upsert calls first, finishes it. One writer at a time.
    """
    partition_by = list(partition_by)
    recover(spark, path, batch.schema, partition_by)
    if not _entries(spark, path):
        reduced = merge_rows(batch.limit(0), batch, keys, order_by, sequence)
        replace_periods(reduced, path, partition_by)
        return
    target = spark.read.schema(batch.schema).parquet(path).select(*batch.columns)
    batch_keys = batch.select(*keys).dropna().distinct()
    stored = target.select(*keys, *partition_by).join(batch_keys, list(keys), "left_semi")
    incoming = batch.dropna(subset=list(keys)).select(*partition_by)
    periods = stored.select(*partition_by).union(incoming).distinct()
    periods.coalesce(1).write.mode("overwrite").parquet(f"{path}/{_PENDING}/periods")
    periods = spark.read.schema(periods.schema).parquet(f"{path}/{_PENDING}/periods")
    touched = periods.collect()  # at most one row per period folder
    if not touched:
        return
    affected = target.where(_in_partitions(partition_by, touched))
    merged = merge_rows(affected, batch, keys, order_by, sequence)
    merged.write.mode("overwrite").parquet(f"{path}/{_PENDING}/rows")
    recover(spark, path, batch.schema, partition_by)


def recover(
    spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str] = ("ano", "mes")
) -> None:
    """Finish an upsert that died while it replaced folders; without one, change nothing.

    Replacing a period by the same pending rows again gives the same table, so a recovery that
    dies is itself recovered by the next.
    """
    pending = f"{path}/{_PENDING}"
    if "_SUCCESS" in _entries(spark, f"{pending}/rows", hidden=True):
        names = list(partition_by)
        rows = spark.read.schema(schema).parquet(f"{pending}/rows")
        kinds = T.StructType([schema[n] for n in names])
        periods = spark.read.schema(kinds).parquet(f"{pending}/periods")
        filled = rows.select(*names).distinct()
        same = F.lit(True)
        for n in names:
            same = same & periods[n].eqNullSafe(filled[n])
        emptied = periods.join(filled, same, "left_anti").collect()  # at most one per folder
        replace_periods(rows, path, names)
        for values in emptied:  # every row moved away: an overwrite would leave the old folder
            _drop(spark, f"{path}/{_folder(names, values)}")
    _drop(spark, f"{pending}/rows/_SUCCESS")  # first, or half-deleted rows would look complete
    _drop(spark, pending)


def _in_partitions(names: Sequence[str], rows: Sequence) -> Column:
    hit = F.lit(False)
    for row in rows:
        same = F.lit(True)
        for name in names:
            same = same & F.col(name).eqNullSafe(F.lit(row[name]))
        hit = hit | same
    return hit


def _folder(names: Sequence[str], values: Sequence) -> str:
    empty = "__HIVE_DEFAULT_PARTITION__"
    return "/".join(f"{n}={empty if v is None else v}" for n, v in zip(names, values))


# The one place that needs the file system itself: Spark has no listing or deletion of its own.


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _entries(spark: SparkSession, path: str, hidden: bool = False) -> set[str]:
    """Names in a folder, without those that Spark's own scans skip unless ``hidden``."""
    system, place = _file_system(spark, path)
    if not system.exists(place):
        return set()
    names = {s.getPath().getName() for s in system.listStatus(place)}
    return names if hidden else {n for n in names if n[0] not in "_."}


def _drop(spark: SparkSession, path: str) -> None:
    system, place = _file_system(spark, path)
    system.delete(place, True)
