"""Files that keep arriving, merged into a partitioned table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlens.operators import versioned
from ledgerlens.operators.upsert import _drop, _entries, upsert
from ledgerlens.operators.windows import latest

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_BATCH = "_batch"


def arriving_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    files_per_batch: int | None = None,
    pattern: str | None = None,
    format: str = "parquet",
) -> DataFrame:
    """Stream of new files below a folder; the query's checkpoint remembers those already read."""
    reader = spark.readStream.schema(schema).format(format)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder)


def drop_repeats(stream: DataFrame, keys: Sequence[str], time: str, within: str) -> DataFrame:
    """Drop rows whose key was seen before, with state kept only as long as ``within``.

    Rows that arrive later than ``within`` are dropped too, repeated or not; where they must stay,
    use ``append_unique``.
    """
    return stream.withWatermark(time, within).dropDuplicatesWithinWatermark(list(keys))


def append_unique(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    order_by: Sequence[Column] = (),
    every: str | None = None,
) -> StreamingQuery:
    """Append the rows whose key is not yet in the table at ``path``, however late they arrive.

    The table itself is the memory, so no state grows and no late row is lost. Of several rows of
    a key in one batch the first in ``order_by`` stays. ``partition_by`` must follow from the keys;
    only folders that the batch touches are then read. A replayed batch adds nothing.
    """
    keys, parts = list(keys), list(partition_by)

    def apply(batch: DataFrame, batch_id: int) -> None:
        order = [*order_by, F.xxhash64(*batch.columns)]
        new = latest(batch, keys, order)
        new.limit(0).write.partitionBy(*parts).mode("append").parquet(path)
        stored = batch.sparkSession.read.schema(batch.schema).parquet(path).select(*keys)
        if parts:
            stored = stored.join(batch.select(*parts).distinct(), parts, "left_semi")
        known = F.lit(True)
        for k in keys:
            known = known & new[k].eqNullSafe(stored[k])
        fresh = new.join(stored, known, "left_anti")
        fresh.write.partitionBy(*parts).mode("append").parquet(path)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def unique_two_ways(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    time: str,
    within: str,
    partition_by: Sequence[str] = (),
    every: str | None = None,
) -> StreamingQuery:
    """Append rows whose key is new; recent rows are judged by state, late ones by the table.

    A row is late if its ``time`` is not after the newest time of earlier batches less ``within``.
    Recent rows pass through deduplication with a watermark, whose state (on the RocksDB store)
    holds the keys of the last ``within`` and forgets older ones; the table is not read for them.
    Late rows are compared with the table in the folders that they fall into. ``time`` must follow
    from the key (the day of a daily key, say), so that all rows of a key change from one way to the
    other together; ``partition_by`` must follow from it too. The border between both ways is stored
    with each batch, and a batch is written to a folder of its own that a replay overwrites.
    Read the table with :func:`unique_rows`.
    """
    keys, parts = list(keys), list(partition_by)
    columns, spark = stream.columns, stream.sparkSession
    progress = f"{path}/_progress"
    way = "_way"

    def border(batch: DataFrame, batch_id: int) -> DataFrame | None:
        """Newest time of the batches before this one, in one row; None for the first."""
        done = [int(n.split("=")[1]) for n in _entries(batch.sparkSession, progress, hidden=True) if "=" in n]
        earlier = [b for b in done if b < batch_id]
        return batch.sparkSession.read.parquet(f"{progress}/batch={max(earlier)}") if earlier else None

    def apply(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return
            newest = border(batch, batch_id)
            new = batch.where(F.col(way) == "state").select(*columns)
            late = batch.where(F.col(way) == "row").select(*columns)
            if newest is None:
                late = late.limit(0)
            else:
                cut = newest.select(F.expr(f"newest - INTERVAL {within}")).scalar()
                new, late = new.where(F.col(time) > cut), late.where(F.col(time) <= cut)
                late = late.dropDuplicates(keys).persist()
            if newest is not None and not late.isEmpty():
                late = _unknown(session, late, path, keys, parts, batch_id)
            rows = new.unionByName(late).withColumn(_BATCH, F.lit(batch_id))
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                _BATCH, *parts
            ).parquet(path)
            latest_time = batch.agg(F.max(time).alias("newest"))
            if newest is not None:
                latest_time = latest_time.union(newest).agg(F.max("newest").alias("newest"))
            latest_time.coalesce(1).write.mode("overwrite").parquet(f"{progress}/batch={batch_id}")
            _drop(session, f"{progress}/batch={batch_id - 2}")
        finally:
            batch.unpersist()

    first = stream.withWatermark(time, within).dropDuplicatesWithinWatermark(keys)
    both = first.withColumn(way, F.lit("state")).unionByName(stream.withColumn(way, F.lit("row")))
    writer = both.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        return writer.trigger(**trigger).start()
    finally:
        spark.conf.set(_PROVIDER, before)


def unique_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table that :func:`unique_two_ways` writes."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def _unknown(
    spark: SparkSession, late: DataFrame, path: str, keys: Sequence[str], parts: Sequence[str], batch_id: int
) -> DataFrame:
    """Late rows whose key no earlier batch has written; reads only the folders they fall into."""
    schema = T.StructType([*late.schema.fields, T.StructField(_BATCH, T.LongType())])
    stored = spark.read.schema(schema).parquet(path).where(F.col(_BATCH) < batch_id)
    if parts:
        stored = stored.join(F.broadcast(late.select(*parts).distinct()), list(parts), "left_semi")
    same = F.lit(True)
    for k in keys:
        same = same & late[k].eqNullSafe(stored[k])
    return late.join(stored, same, "left_anti")


def commit_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = ("ano", "mes"),
    order_by: Sequence[Column] = (),
    sequence: Sequence[str] = (),
    every: str | None = None,
) -> StreamingQuery:
    """Every micro-batch as one version of the table at ``path`` (see ``operators.versioned``).

    A replayed batch finds its rows stored and makes no version; an empty one does nothing.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            if not rows.isEmpty():
                versioned.commit(rows.sparkSession, path, rows, keys, partition_by, order_by, sequence)
        finally:
            rows.unpersist()

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def merge_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = ("ano", "mes"),
    order_by: Sequence[Column] = (),
    sequence: Sequence[str] = (),
    every: str | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Upsert every micro-batch into the table at ``path``.

    ``every`` such as ``"5 minutes"`` keeps the query running; without it all files present are
    drained and the query ends. A batch that is replayed after a failure gives the same table,
    because the upsert is idempotent. Empty batches do nothing.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = prepare(batch) if prepare else batch
        rows = rows.persist()
        try:
            if not rows.isEmpty():
                upsert(rows.sparkSession, path, rows, keys, partition_by, order_by, sequence)
        finally:
            rows.unpersist()

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()
