"""Loads that are checked in the pass that writes them.

A batch is read once. Its rows are written, good ones and those that break a rule apart, while
observed metrics count what each rule finds. The batch is published, by a small manifest that
names its folder, only if no more rows than allowed are bad; otherwise readers go on with what was
published before, and the batch lies in quarantine with the names of the broken rules.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.upsert import _entries

_STATE, _BROKEN = "_estado", "_regras"
GOOD, BAD = "valida", "quarentena"


def load(
    batch: DataFrame,
    path: str,
    rules: Mapping[str, Column],
    at_most: float = 0.05,
    partition_by: Sequence[str] = (),
) -> dict[str, int | bool]:
    """Write a batch and judge it; counts by rule, ``linhas``, ``ruins``, ``lote`` and ``publicado``.

    A rule is broken where it is false; an unknown result does not break it. A batch of which more
    than the share ``at_most`` is bad is not published.
    """
    spark = batch.sparkSession
    numbers = [int(n.split("=")[1]) for n in _entries(spark, f"{path}/lotes")]
    number = max(numbers, default=0) + 1
    broken = F.array_compact(F.array(*[F.when(~rule, F.lit(name)) for name, rule in rules.items()]))
    marked = batch.withColumn(_BROKEN, broken).withColumn(
        _STATE, F.when(F.size(_BROKEN) > 0, F.lit(BAD)).otherwise(F.lit(GOOD))
    )
    seen = Observation()
    watched = marked.observe(
        seen,
        F.count(F.lit(1)).alias("linhas"),
        F.count_if(F.col(_STATE) == BAD).alias("ruins"),
        *[F.count_if(F.array_contains(_BROKEN, name)).alias(name) for name in rules],
    )
    folder = f"{path}/lotes/lote={number}"
    watched.write.partitionBy(_STATE, *partition_by).parquet(folder)
    report = dict(seen.get)
    report["lote"], report["publicado"] = number, report["ruins"] <= at_most * report["linhas"]
    if report["publicado"]:
        before = _published(spark, path)
        listed = spark.createDataFrame([(n,) for n in [*before, number]], "lote int")
        listed.coalesce(1).write.mode("overwrite").parquet(f"{path}/publicados/lote={number}")
    return report


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Good rows of all published batches."""
    folders = [f"{path}/lotes/lote={n}/{_STATE}={GOOD}" for n in _published(spark, path)]
    folders = [f for f in folders if _entries(spark, f)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/lotes").parquet(*folders).select(*schema.names)


def quarantine(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Bad rows of all batches, published or not, with the rules they break and their batch."""
    more = [(_BROKEN, T.ArrayType(T.StringType())), (_STATE, T.StringType()), ("lote", T.IntegerType())]
    wide = T.StructType([*schema.fields, *[T.StructField(n, kind) for n, kind in more]])
    rows = spark.read.schema(wide).parquet(f"{path}/lotes")
    names = [n for n in wide.names if n != _STATE]
    return rows.where(F.col(_STATE) == BAD).select(*names)


def _published(spark: SparkSession, path: str) -> list[int]:
    """Batches that the newest complete manifest lists: one small number each."""
    found = sorted((int(n.split("=")[1]) for n in _entries(spark, f"{path}/publicados")), reverse=True)
    for number in found:
        place = f"{path}/publicados/lote={number}"
        if "_SUCCESS" in _entries(spark, place, hidden=True):
            return sorted(r["lote"] for r in spark.read.schema("lote int").parquet(f"{place}/*.parquet").collect())
    return []
