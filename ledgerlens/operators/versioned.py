"""Tables of numbered versions in Parquet: updates by key, snapshots for readers, a feed of changes.

Below the table's path stand, one folder per version,

* ``rows``      by what the version did to them and by period: the rows that it inserted, updated
                (before and after) and deleted, which are its feed, and those it kept in the periods
                that it rewrote. Kept, inserted and updated ones are the table's; each row is written once,
* ``keys``      hash of the key and period of every row that the version wrote: the key index,
* ``manifest``  all periods of the table at that version, and the version whose folder holds each.

The manifest is written last: a version exists once its manifest is complete, so readers see the
table before or after an update and never one in between, and a run that dies leaves nothing that
anyone reads. The next one takes the same number and overwrites what is left of it. One writer at
a time. With a table format at hand, its MERGE, time travel and change feed do the same.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.lineage import materialize, new_path, short_shuffles
from ledgerlens.operators.upsert import _drop, _entries
from ledgerlens.operators.windows import latest
from ledgerlens.sources.writers import _by_period

KIND, VERSION = "_change", "_version"
INSERT, BEFORE, AFTER, DELETE = "insert", "update_before", "update_after", "delete"
_KEEP = "keep"
_FEED, _TABLE = (INSERT, BEFORE, AFTER, DELETE), (_KEEP, INSERT, AFTER)
_HASH, _HOLDER, _KINDS = "_key_hash", "_holder", "_kinds"
_CODEC = "zstd"  # of what stays on disk


def newest(spark: SparkSession, path: str) -> int:
    """Number of the newest complete version; 0 for a table that does not exist yet."""
    done = [int(n.split("=")[1]) for n in _entries(spark, f"{path}/manifest")]
    for number in sorted(done, reverse=True):
        if "_SUCCESS" in _entries(spark, _at(path, "manifest", number), hidden=True):
            return number
    return 0


def periods(
    spark: SparkSession,
    path: str,
    partition_by: Sequence[str],
    version: int | None = None,
    schema: T.StructType | None = None,
    kinds: bool = False,
) -> list[Row]:
    """Periods of a version with the version that holds each: at most one row per period folder.

    With the table's ``schema`` the manifest's own need not be looked up. ``kinds`` puts before the
    holder which kinds of the table's rows lie there.
    """
    number = newest(spark, path) if version is None else version
    if not number:
        return []
    reader = spark.read if schema is None else spark.read.schema(_manifest(schema, partition_by))
    more = [_KINDS] if kinds else []
    return reader.parquet(_at(path, "manifest", number)).select(*partition_by, *more, _HOLDER).collect()


def _manifest(schema: T.StructType, partition_by: Sequence[str]) -> T.StructType:
    own = [T.StructField(_KINDS, T.StringType()), T.StructField(_HOLDER, T.IntegerType())]
    return T.StructType([*[schema[p] for p in partition_by], *own])


def read(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partition_by: Sequence[str],
    version: int | None = None,
    only: Iterable[Sequence] | None = None,
) -> DataFrame:
    """The table at a version (the newest if none is named); ``only`` some of its periods.

    Just the folders of those periods are listed and read.
    """
    held = periods(spark, path, partition_by, version, schema, kinds=True)
    if only is not None:
        wanted = {tuple(p) for p in only}
        held = [p for p in held if tuple(p)[:-2] in wanted]
    folders = [
        f"{_kind(path, p[_HOLDER], kind)}/{_folder(spark, partition_by, p)}"
        for p in held
        for kind in p[_KINDS].split(",")
    ]
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("basePath", f"{path}/rows").parquet(*folders)
    return rows.select(*schema.names)


def changes(
    spark: SparkSession, path: str, schema: T.StructType, since: int = 0, until: int | None = None
) -> DataFrame:
    """Changed rows of the versions after ``since``, with what happened and in which version."""
    last = newest(spark, path) if until is None else until
    folders = [
        _kind(path, v, kind)
        for v in range(since + 1, last + 1)
        for kind in _FEED
        if f"{KIND}={kind}" in _entries(spark, _at(path, "rows", v), hidden=True)
    ]
    wide = T.StructType([*schema.fields, T.StructField(KIND, T.StringType())])
    if not folders:
        return spark.createDataFrame([], T.StructType([*wide.fields, T.StructField(VERSION, T.IntegerType())]))
    rows = spark.read.schema(wide).option("basePath", f"{path}/rows").parquet(*folders)
    return rows.select(*schema.names, KIND, F.col("version").cast("int").alias(VERSION))


def replayed(feed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table that a feed, from its first version on, amounts to."""
    columns = [c for c in feed.columns if c not in (KIND, VERSION)]
    # within a version a key has one row of these three kinds
    last = latest(feed.where(F.col(KIND) != BEFORE), keys, [F.col(VERSION).desc()])
    return last.where(F.col(KIND) != DELETE).select(*columns)


def signed(feed: DataFrame, name: str = "_sign") -> DataFrame:
    """Feed rows with +1 for those that came and -1 for those that went."""
    return feed.withColumn(name, F.when(F.col(KIND).isin(INSERT, AFTER), F.lit(1)).otherwise(F.lit(-1)))


def commit(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    partition_by: Sequence[str] = ("ano", "mes"),
    order_by: Sequence[Column] = (),
    sequence: Sequence[str] = (),
    deletes: DataFrame | None = None,
    unique: bool = False,
    few: bool = False,
    settled: bool = False,
    combine: Callable[[Column, Column], Column] | None = None,
) -> int:
    """Merge a batch, and remove the keys of ``deletes``, as one new version; its number.

    Several batch rows of a key are reduced to the first in ``order_by``; with ``sequence`` a stored
    row that is as new stays. A key both in the batch and in ``deletes`` is kept. The key index
    names the periods where the keys are stored, so only those folders and those of the batch are
    read, and only folders with a changed row are rewritten. A batch that changes nothing, such as a
    replayed one, makes no version. What the first version inserts is written without a look at
    stored rows; later, stored rows and batch meet in one join, which writes every row once.

    ``unique`` says that the batch holds one row per key, so that it need not be dealt by key to find
    out. ``few`` says that the periods stay few however many rows there are, such as years: each
    task writes its own file of a period, and rows are not dealt by period before. ``settled`` says
    that the period follows from the key: no index is needed to find stored rows, and none is kept.
    ``combine`` makes the row to store out of the batch's and the stored one of a key, two structs
    of which the second is NULL for a new key, or NULL if the key is to go.
    """
    keys, partition_by, columns, schema = list(keys), list(partition_by), batch.columns, batch.schema
    last, copies = newest(spark, path), []
    order = [F.col(c).desc() for c in sequence] + list(order_by) + [F.xxhash64(*columns)]

    def copied(df: DataFrame, name: str) -> DataFrame:
        copies.append(new_path(spark, name))
        return materialize(df, path=copies[-1])

    source, stored = batch.dropna(subset=keys), None
    if last:
        source = copied(source, "batch")
        hit = source.select(*partition_by).distinct().collect()  # one row per folder
        if deletes is not None:
            deletes = copied(deletes.select(*keys).dropna().distinct(), "deletes")
        held = {tuple(p)[:-1] for p in periods(spark, path, partition_by, last, schema)}
        hit = held & {_named(p) for p in hit}
        if not settled and hit != held:
            wanted = source.select(*keys)
            wanted = wanted if deletes is None else wanted.union(deletes)
            hit |= held & {_named(p) for p in _located(spark, path, wanted, schema, partition_by, last)}
        stored = read(spark, path, schema, partition_by, last, hit)
    source = source if unique else latest(source, keys, order).select(*columns)
    written = _merged(stored, source, keys, sequence, deletes, combine)
    rows_path = _at(path, "rows", last + 1)
    with short_shuffles(spark):
        _by_period(written, () if few else partition_by).write.mode("overwrite").options(
            partitionOverwriteMode="static", compression=_CODEC
        ).partitionBy(KIND, *partition_by).parquet(rows_path)
    for copy in copies:
        _drop(spark, copy)

    wide = T.StructType([*schema.fields, T.StructField(KIND, T.StringType())])
    out = spark.read.schema(wide).parquet(rows_path)
    found = [(tuple(p)[1:], p[KIND]) for p in out.select(KIND, *partition_by).distinct().collect()]  # a few per folder
    touched = {p for p, kind in found if kind in _FEED}
    if not touched:
        _drop(spark, rows_path)
        return last
    for p, kind in found:
        if p not in touched:  # read, but nothing in it has changed: it stays where it is
            _drop(spark, f"{_kind(path, last + 1, kind)}/{_folder(spark, partition_by, dict(zip(partition_by, p)))}")
    if not settled:
        new = out.where(F.col(KIND).isin(INSERT, AFTER)).select(*columns)
        with short_shuffles(spark):
            _index(new, keys, partition_by).write.mode("overwrite").option("compression", _CODEC).parquet(
                _at(path, "keys", last + 1)
            )

    live = [tuple(p) for p in periods(spark, path, partition_by, last, schema, kinds=True) if tuple(p)[:-2] not in touched]
    for p in touched:
        kinds = [kind for q, kind in found if q == p and kind in _TABLE]
        live += [(*p, ",".join(kinds), last + 1)] if kinds else []
    manifest = spark.createDataFrame(live, _manifest(schema, partition_by)).coalesce(1)
    manifest.write.mode("overwrite").parquet(_at(path, "manifest", last + 1))
    return last + 1


def reindex(spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], partition_by: Sequence[str]) -> None:
    """Replace the key index of all versions by one of the rows that the table holds now.

    Entries of rows that have moved or gone do no harm, they only name a folder too many; this drops
    them. They stay if the run dies before the new index is complete.
    """
    last = newest(spark, path)
    fresh = _index(read(spark, path, schema, partition_by, last), list(keys), partition_by)
    fresh.write.mode("overwrite").parquet(f"{path}/keys/base={last}")
    for v in range(1, last + 1):
        _drop(spark, _at(path, "keys", v))


def vacuum(spark: SparkSession, path: str, partition_by: Sequence[str], keep: int = 1) -> None:
    """Remove kept rows that none of the newest ``keep`` versions shows, and older manifests.

    What versions inserted, updated and deleted stays, as it is the feed."""
    last = newest(spark, path)
    kept = range(max(1, last - keep + 1), last + 1)
    shown = {p[_HOLDER] for v in kept for p in periods(spark, path, partition_by, v)}
    for v in range(1, kept.start):
        _drop(spark, _at(path, "manifest", v))
    for v in range(1, last + 1):
        if v not in shown:
            _drop(spark, _kind(path, v, _KEEP))


def _at(path: str, part: str, version: int) -> str:
    return f"{path}/{part}/version={version}"


def _named(period: Sequence) -> tuple:
    """A period as folders name it: an empty text is stored as NULL."""
    return tuple(None if x == "" else x for x in period)


def _kind(path: str, version: int, kind: str) -> str:
    return f"{_at(path, 'rows', version)}/{KIND}={kind}"


def _folder(spark: SparkSession, names: Sequence[str], values: Mapping | Row) -> str:
    """Period folder below a version, named as Spark's writer names it."""
    named = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join(named.getPartitionPathString(n, None if values[n] is None else str(values[n])) for n in names)


def _index(rows: DataFrame, keys: Sequence[str], partition_by: Sequence[str]) -> DataFrame:
    """Hash of every key beside its period, for rows with one row per key."""
    return rows.select(F.xxhash64(*keys).alias(_HASH), *partition_by)


def _indexed(spark: SparkSession, path: str, last: int) -> list[str]:
    """Index folders that cover the versions up to ``last``."""
    names = _entries(spark, f"{path}/keys")
    bases = sorted(int(n.split("=")[1]) for n in names if n.startswith("base="))
    done = [b for b in bases if b <= last and "_SUCCESS" in _entries(spark, f"{path}/keys/base={b}", hidden=True)]
    folders = [f"{path}/keys/base={done[-1]}"] if done else []
    first = done[-1] + 1 if done else 1
    return folders + [_at(path, "keys", v) for v in range(first, last + 1)]


def _located(
    spark: SparkSession,
    path: str,
    wanted: DataFrame,
    schema: T.StructType,
    partition_by: Sequence[str],
    last: int,
) -> list[tuple]:
    """Periods where rows with the wanted keys may be stored: at most one row per folder."""
    folders = _indexed(spark, path, last)
    if not folders:
        return []
    slim = T.StructType([T.StructField(_HASH, T.LongType()), *[schema[p] for p in partition_by]])
    index = spark.read.schema(slim).option("basePath", f"{path}/keys").parquet(*folders)
    hashes = wanted.select(F.xxhash64(*wanted.columns).alias(_HASH))
    return [tuple(p) for p in index.join(hashes, _HASH, "left_semi").select(*partition_by).distinct().collect()]


def _merged(
    before: DataFrame | None,
    source: DataFrame,
    keys: Sequence[str],
    sequence: Sequence[str],
    deletes: DataFrame | None,
    combine: Callable[[Column, Column], Column] | None,
) -> DataFrame:
    """Every row that a version writes, with its kind: the rows of the batch beside the stored ones."""
    columns = source.columns
    row = F.struct(*columns)
    if before is None:
        both = source.select(row.alias("_new"), F.lit(None).cast(source.schema).alias("_old"), F.lit(False).alias("_gone"))
    else:
        gone = F.lit(False)
        if deletes is not None:
            names = {k: f"_d_{k}" for k in keys}
            same = F.lit(True)
            for k in keys:
                same = same & (F.col(k) == F.col(names[k]))
            before, gone = before.join(deletes.withColumnsRenamed(names).hint("merge"), same, "left"), F.col(names[keys[0]]).isNotNull()
        old = before.select(*keys, row.alias("_old"), gone.alias("_gone"))
        # both sides lie by key after this join, the batch already where it was reduced by key
        both = source.select(*keys, row.alias("_new")).join(old.hint("merge"), list(keys), "full")
        both = both.select("_new", "_old", F.coalesce("_gone", F.lit(False)).alias("_gone"))
    new, old = F.col("_new"), F.col("_old")
    if combine is not None:
        both = both.withColumn("_kept", F.when(new.isNotNull(), combine(new, old)))
        new, gone = F.col("_kept"), F.col("_new").isNotNull() & F.col("_kept").isNull()
    else:
        gone = F.col("_gone") & new.isNull()
    differs = F.lit(False)
    for c in columns:
        differs = differs | ~new[c].eqNullSafe(old[c])
    if sequence:
        differs = differs & (F.struct(*[new[c] for c in sequence]) > F.struct(*[old[c] for c in sequence]))

    def image(row: Column, kind: str) -> Column:
        return F.struct(row.alias("row"), F.lit(kind).alias("kind"))

    images = (
        F.when(old.isNull(), F.when(new.isNotNull(), F.array(image(new, INSERT))))
        .when(gone, F.array(image(old, DELETE)))
        .when(new.isNotNull() & differs, F.array(image(old, BEFORE), image(new, AFTER)))
        .otherwise(F.array(image(old, _KEEP)))
    )
    out = both.select(F.explode(images).alias("_x"))
    return out.select(*[F.col(f"_x.row.`{c}`").alias(c) for c in columns], F.col("_x.kind").alias(KIND))

