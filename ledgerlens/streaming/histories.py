"""Versions of changing records, kept while their status rows arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.operators import versioned
from ledgerlens.operators.history import scd2_build
from ledgerlens.operators.lineage import materialize

BUCKET = "_folder"


def apply_rows(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    key: Sequence[str],
    updated_at: str,
    tracked: Sequence[str],
    sequence: Sequence[str],
    buckets: int = 256,
) -> None:
    """Add status rows, late ones included, to the log and the history stored at ``path``.

    Both lie in folders by a hash of the key. The rows go to the log first; at one instant of a key
    the one with the highest ``sequence`` counts, whichever came first. Then the keys of the batch
    are rebuilt from their log, which is read in the folders of those keys only, and the history
    takes the difference: only folders with a changed version are rewritten. A replayed batch, also
    one that died between both tables, leads to the same history. Rows without key or time are dropped.
    """
    key = list(key)
    rows = rows.dropna(subset=[*key, updated_at]).withColumn(
        BUCKET, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")
    )
    rows = materialize(rows, "status")
    log, history = f"{path}/log", f"{path}/history"
    versioned.commit(spark, log, rows, [*key, updated_at], [BUCKET], sequence=sequence)
    hit = rows.select(BUCKET).distinct().collect()  # at most ``buckets`` rows
    keys = rows.select(*key).distinct()
    mine = versioned.read(spark, log, rows.schema, [BUCKET], only=hit).join(keys, key, "left_semi")
    built = materialize(scd2_build(mine, key, updated_at, tracked, [F.col(c).desc() for c in sequence]), "versions")
    stored = versioned.read(spark, history, built.schema, [BUCKET], only=hit).join(keys, key, "left_semi")
    gone = stored.join(built.select("scd_id"), "scd_id", "left_anti").select("scd_id")
    versioned.commit(spark, history, built, ["scd_id"], [BUCKET], deletes=gone)


def history_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    key: Sequence[str],
    updated_at: str,
    tracked: Sequence[str],
    sequence: Sequence[str],
    buckets: int = 256,
    every: str | None = None,
) -> StreamingQuery:
    """:func:`apply_rows` for every micro-batch; empty ones do nothing."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            apply_rows(batch.sparkSession, path, batch, key, updated_at, tracked, sequence, buckets)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def history(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The history stored at ``path``; ``schema`` is that of its columns without the bucket."""
    wide = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    return versioned.read(spark, f"{path}/history", wide, [BUCKET]).drop(BUCKET)
