"""Slowly changing history: half-open versions built from a status log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.columns import truth
from ledgerlens.functions.dates import days_between
from ledgerlens.functions.keys import audit_hash, surrogate_key
from ledgerlens.operators.joins import not_in
from ledgerlens.operators.windows import LONG_LOG, by_length, in_buckets, next_in_buckets, previous_in_buckets


def scd2_build(
    log: DataFrame,
    key: Sequence[str],
    updated_at: str,
    tracked: Sequence[str],
    tie: Sequence[Column] = (),
    unit: str = "month",
    long_log: int = LONG_LOG,
) -> DataFrame:
    """Versions ``[valid_from, valid_to)`` of the tracked attributes, NULL for the open end.

    Rows without key or time are dropped. Of several rows of a key at one instant the first in
    ``tie`` order counts. Runs of equal states collapse into one version. A key with up to
    ``long_log`` rows is one task's; the rows of longer logs are spread over calendar buckets, where
    ``unit`` is the bucket in which one task handles one key: choose a finer one for very dense logs.
    """
    key, tracked = list(key), list(tracked)
    rows = log.dropna(subset=[*key, updated_at])
    order = list(tie) or [F.col("_state")]

    def states(part: DataFrame, *by: str) -> DataFrame:
        """One row per instant with its state; all windows after it share its shuffle."""
        instant = Window.partitionBy(*by, updated_at).orderBy(*order)
        moved = part.repartition(*by).withColumn("_state", F.struct(*tracked))  # not moved beside its columns
        numbered = moved.withColumn("_nth", F.row_number().over(instant))
        return numbered.where(F.col("_nth") == 1).drop("_nth")

    def starts(seen: DataFrame) -> DataFrame:
        return seen.where(~F.col("_before").eqNullSafe(F.col("_state")))

    short, long = by_length(rows, key, long_log)
    in_time = Window.partitionBy(*key).orderBy(updated_at)
    whole = starts(states(short, *key).withColumn("_before", F.lag("_state").over(in_time)))
    whole = whole.withColumn("valid_to", F.lead(updated_at).over(in_time))
    spread = states(in_buckets(long, updated_at, unit), *key, "_bucket")
    spread = starts(previous_in_buckets(spread, key, updated_at, "_state", "_before"))
    spread = next_in_buckets(spread, key, updated_at, "valid_to").drop("_bucket")
    versions = whole.unionByName(spread)
    attributes = [c for c in log.columns if c not in key and c != updated_at]
    return versions.select(
        surrogate_key(*key, updated_at).alias("scd_id"),
        *key,
        *attributes,
        F.col(updated_at).alias("valid_from"),
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )


def scd2_apply(
    history: DataFrame,
    log: DataFrame,
    changes: DataFrame,
    key: Sequence[str],
    updated_at: str,
    tracked: Sequence[str],
    tie: Sequence[Column] = (),
    unit: str = "month",
) -> DataFrame:
    """History after new status rows, late ones included.

    Only keys with a change are rebuilt, from their rows in the stored ``log`` and the changes: a
    late row can split a version whose later, equal status rows the history no longer shows. All
    other keys pass through untouched. At one instant a changed row counts before a stored one.
    """
    key = list(key)
    touched = changes.select(*key).dropna().distinct()
    old = log.join(touched, key, "left_semi").withColumn("_arrival", F.lit(0))
    rows = old.unionByName(changes.withColumn("_arrival", F.lit(1)))
    order = [F.col("_arrival").desc(), *(tie or [audit_hash(*tracked)])]
    rebuilt = scd2_build(rows, key, updated_at, tracked, order, unit).drop("_arrival")
    return history.join(touched, key, "left_anti").unionByName(rebuilt)


def version_flags(
    history: DataFrame,
    situation: str = "situacao",
    condition: str = "condicao_eleitoral",
    photo: str = "url_foto",
    email: str = "email_gabinete",
) -> DataFrame:
    """Flags of a person version: open, in office, titular, with photo, with e-mail."""
    return history.withColumns(
        {
            "is_current": F.col("valid_to").isNull(),
            "em_exercicio": truth(F.col(situation).ilike("%EXERC%")),
            "eh_titular": truth(F.col(condition) == "TITULAR"),
            "tem_foto": F.col(photo).isNotNull(),
            "tem_email_gabinete": F.col(email).isNotNull(),
        }
    )


def prefer_first(first: DataFrame, second: DataFrame, key: Sequence[str]) -> DataFrame:
    """All rows of ``first`` plus those of ``second`` for keys that ``first`` lacks."""
    return first.unionByName(not_in(second, first, key), allowMissingColumns=True)


def stays(history: DataFrame, as_of: str | Column, out: str = "dias_no_estado") -> DataFrame:
    """Length of each version in days; an open one runs to ``as_of``."""
    end = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    finish = F.coalesce(F.col("valid_to").cast("date"), end)
    return history.withColumn(out, days_between("valid_from", finish).cast("bigint"))
