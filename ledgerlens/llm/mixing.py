"""Mixing sources to target weights by fair scheduling of blocks.

Each source's documents form blocks of equal size. With target weight w, block j of a source is
released at slot floor((j - 1) / w) and due at slot ceil(j / w); earliest deadline first among the
released blocks keeps every source within less than one block of its share at every slot. Weights
are whole parts of a period, after which the schedule repeats; so one period, bounded by a
parameter, fixes the slot of every block of any source, and the rest is joins and arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import settled, stored, table

PERIOD = 1000  # slots; weights are rounded to whole slots of a period
BLOCK = 16  # documents per block
SMOOTH = 0.7  # default targets: share of each source to this power, so that small ones gain
_LOW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def target_parts(counts: DataFrame, weights: dict[str | None, float] | None, period: int) -> DataFrame:
    """``source, parts``: slots of each source in a period, at least one, summing to the period.

    ``counts`` has one row per source (source, n). Largest remainders get the slots left over.
    More sources than slots make the period longer, to a slot per source.
    """
    if weights is None:
        weight = F.pow(F.col("n").cast("double"), F.lit(SMOOTH))
    else:
        weight = F.lit(0.0)
        for source, value in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(source)), F.lit(float(value))).otherwise(weight)
    every = Window.partitionBy()  # one row per source
    rows = counts.withColumn("w", weight).withColumn("share", F.col("w") / F.sum("w").over(every))
    size = F.greatest(F.lit(period), F.count(F.lit(1)).over(every))
    spare = rows.withColumn("size", size).withColumn("want", F.coalesce("share", F.lit(0.0)) * (F.col("size") - F.count(F.lit(1)).over(every)))
    floor = spare.withColumn("base", F.floor("want")).withColumn("left", F.col("size") - F.count(F.lit(1)).over(every) - F.sum("base").over(every))
    place = F.row_number().over(Window.orderBy(F.desc(F.col("want") - F.col("base")), F.col("source").asc_nulls_first()))
    return floor.select("source", (F.col("base") + 1 + (place <= F.col("left")).cast("bigint")).alias("parts"))


def period_schedule(parts: DataFrame) -> DataFrame:
    """``source, turn, slot``: the slots (from 0) of each source in one period, by EDF.

    Folds over the slots of the period: of the sources whose next block is released, the one with
    the earliest deadline runs; ties go to the larger weight, then to the name.
    """
    sources = parts.agg(
        F.sort_array(F.collect_list(F.struct(F.col("parts").alias("p"), "source")), asc=False).alias("s"),
        F.sum("parts").alias("size"),
    )  # one row per source

    def step(state: Column, slot: Column) -> Column:
        ready = F.filter(
            F.transform(
                F.sequence(F.lit(0), F.size("s") - 1),
                lambda i: F.struct(
                    F.ceil((state["ran"][i] + 1) * F.col("size") / F.col("s")[i]["p"]).alias("due"),
                    i.alias("i"),
                    F.floor(state["ran"][i] * F.col("size") / F.col("s")[i]["p"]).alias("open"),
                    state["ran"][i].alias("turn"),
                ),
            ),
            lambda x: x["open"] <= slot,
        )
        chosen = F.array_min(ready)
        return F.struct(
            F.transform(state["ran"], lambda n, i: n + (i == chosen["i"]).cast("bigint")).alias("ran"),
            F.concat(
                state["plan"],
                F.array(F.struct(chosen["i"].alias("i"), chosen["turn"].alias("turn"), slot.alias("slot"))),
            ).alias("plan"),
        )

    start = F.struct(
        F.transform("s", lambda x: F.lit(0).cast("bigint")).alias("ran"),
        F.expr("cast(array() as array<struct<i:int,turn:bigint,slot:bigint>>)").alias("plan"),
    )
    slots = F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1)
    run = sources.where(F.col("size") > 0).select("s", F.aggregate(slots, start, step)["plan"].alias("plan"))
    return run.select("s", F.explode("plan").alias("x")).select(
        F.col("s")[F.col("x.i")]["source"].alias("source"), F.col("x.turn").alias("turn"), F.col("x.slot").alias("slot")
    )


def _numbered(rows: DataFrame) -> DataFrame:
    """``row`` from 0 within each source, by a hash of the id, without gathering a source.

    Rows are range-partitioned over all sources, so a source with a third of all rows is spread;
    each partition numbers its own rows, and one row per (source, partition) carries the offset.
    """
    order = [F.col("source").asc_nulls_first(), F.col("h"), F.col("doc_id").asc_nulls_first(), F.col("row_id")]
    placed = settled(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id())
    ).withColumn("chunk", F.shiftright("at", _LOW_BITS))
    chunks = placed.groupBy("source", "chunk").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = chunks.select(
        F.col("source").alias("of"), F.col("chunk").alias("in"),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
    )
    return placed.join(offsets, (F.col("chunk") == F.col("in")) & F.col("source").eqNullSafe(F.col("of"))).select(
        "source", "doc_id", "row_id", (F.col("at") + F.col("shift")).alias("row")
    )


def mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    period: int = PERIOD,
    block: int = BLOCK,
    row: str | None = None,
) -> DataFrame:
    """``doc_id, source, parts, period, block, release, deadline, slot, place, balanced, row_id``.

    Every row appears once. ``place`` orders the mixed stream; ``balanced`` marks the stretch in
    which every source still has blocks, so shares deviate by less than one block. After it the
    schedule goes on without the sources that have run out: nothing is dropped or repeated, and
    the other sources keep their proportions to each other. Without ``weights`` targets are the
    shares of all rows to the power 0.7; a source that is not named gets one slot per period.
    Null sources are a source of their own; repeated rows and null ids are rows like any others
    (told apart by ``row_id``, their number in one scan, or the stored column that ``row`` names); an
    empty table gives an empty result.
    """
    slim = docs.select(
        F.col("source").cast("string").alias("source"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.col(row) if row else F.monotonically_increasing_id()).alias("row_id"),
    ).withColumn("h", F.xxhash64("doc_id"))
    counts = settled(slim.groupBy("source").agg(F.count(F.lit(1)).alias("n")))
    parts = settled(target_parts(counts, weights, period))
    plan = settled(period_schedule(parts)).select(
        F.col("source").alias("__s"), F.col("turn").alias("__turn"), F.col("slot").alias("__slot")
    )
    whole_period = parts.agg(F.sum("parts")).first()[0] or 1
    numbered = _numbered(slim).withColumn("block", F.floor(F.col("row") / block))
    ends = counts.join(
        parts.withColumnsRenamed({"source": "__p", "parts": "__parts"}), F.col("source").eqNullSafe(F.col("__p"))
    ).select("__p", "__parts", (F.floor(F.col("n") * whole_period / (F.col("__parts") * block))).alias("last"))
    horizon = ends.agg(F.min("last")).first()[0] or 0
    # one row per source and per slot of a period: bounded by `period`, so broadcast
    rows = numbered.join(F.broadcast(ends.drop("last")), F.col("source").eqNullSafe(F.col("__p")))
    rows = rows.withColumn("turn", F.col("block") % F.col("__parts"))
    rows = rows.join(F.broadcast(plan), F.col("source").eqNullSafe(F.col("__s")) & (F.col("turn") == F.col("__turn")))
    slot = F.floor(F.col("block") / F.col("__parts")) * whole_period + F.col("__slot")
    return rows.select(
        "doc_id", "source", F.col("__parts").alias("parts"), F.lit(whole_period).cast("bigint").alias("period"),
        "block",
        F.floor(F.col("block") * whole_period / F.col("__parts")).alias("release"),
        F.ceil((F.col("block") + 1) * whole_period / F.col("__parts")).alias("deadline"),
        slot.alias("slot"),
        (slot * block + F.col("row") % block).alias("place"),
        (slot < horizon).alias("balanced"),
        "row_id",
    )


def in_mixed_order(docs: DataFrame, **options) -> DataFrame:
    """``docs`` in the order of the mixed stream, every row once, columns unchanged.

    Rows are numbered once and stored with their number, as another scan may number them otherwise.
    They are joined to their places by it, then range-partitioned and sorted by place, so files
    written from the result follow the schedule.
    """
    keyed = stored(docs.withColumn("__id", F.monotonically_increasing_id()), "numbered")
    places = mix(keyed, row="__id", **options).select(F.col("row_id").alias("__row"), F.col("place").alias("__place"))
    joined = keyed.join(places, F.col("__id") == F.col("__row"))
    out = joined.repartitionByRange("__place").sortWithinPartitions("__place")
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).drop("row_id")
