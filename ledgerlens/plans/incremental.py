"""Marts kept up to date from a feed of changed documents, without reading the others again.

What a mart needs of its documents is kept as totals per group in a versioned table: sums and
counts take each change with its sign, so a correction is the old row subtracted and the new one
added. What cannot be subtracted from, such as a number of distinct documents or a latest date, is
kept as one group per value with its count; a value whose count falls to nothing goes. Groups lie
in folders by a hash of the entity, and only folders with a changed group are read and rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions import rules
from ledgerlens.functions.keys import surrogate_key
from ledgerlens.functions.numeric import ratio
from ledgerlens.operators import versioned
from ledgerlens.plans import explore, marts

ROWS = "_rows"  # documents of a group; without any the group goes
_GROUP, _BUCKET = "_group", "_bucket"


@dataclass(frozen=True)
class Kept:
    """Totals that a mart keeps: groups by ``keys``, in folders by the hash of ``entity``."""

    entity: Sequence[str]
    keys: Sequence[str]
    sums: Sequence[str]
    buckets: int = 16

    def apply(self, spark: SparkSession, path: str, lines: DataFrame) -> int:
        """Add lines (keys, sums, ``_sign``) to the totals at ``path``; the version that results.

        Lines that cancel out change nothing. A feed applied twice counts twice.
        """
        sign = F.col("_sign")
        delta = lines.groupBy(*self.keys).agg(
            F.sum(sign).cast("bigint").alias(ROWS),
            *[F.sum(F.coalesce(F.col(c), F.lit(0)) * sign).cast("decimal(38,6)").alias(c) for c in self.sums],
        )
        names = [ROWS, *self.sums]
        moved = F.lit(False)
        for c in names:
            moved = moved | (F.col(c) != 0)
        delta = delta.where(moved).select(
            "*",
            F.unhex(surrogate_key(*self.keys)).alias(_GROUP),
            F.pmod(F.xxhash64(*self.entity), F.lit(self.buckets)).cast("int").alias(_BUCKET),
        )

        def total(new: Column, old: Column) -> Column:
            sums = {c: (new[c] + F.coalesce(old[c], F.lit(0))).cast(delta.schema[c].dataType) for c in names}
            return F.when(sums[ROWS] > 0, F.struct(*[sums.get(c, new[c]).alias(c) for c in delta.columns]))

        return versioned.commit(
            spark, path, delta, [_GROUP], [_BUCKET], unique=True, few=True, settled=True, combine=total
        )

    def read(self, spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
        """The kept totals; ``like`` are lines as given to ``apply``, for the types of the keys."""
        fields = [f"{like.schema[k].name} {like.schema[k].dataType.simpleString()}" for k in self.keys]
        fields += [f"{ROWS} bigint", *[f"{c} decimal(38,6)" for c in self.sums]]
        schema = spark.createDataFrame([], ", ".join([*fields, f"{_GROUP} binary", f"{_BUCKET} int"])).schema
        return versioned.read(spark, path, schema, [_BUCKET]).drop(_GROUP, _BUCKET)


SPENDING = Kept(
    marts.VERSION,
    [*marts.VERSION, "cod_documento", "_month", "data_documento"],
    ["_doc", "_net", "_cut", *marts.SPENDING_BANDS],
)
YEARLY = Kept(["deputado_id"], ["deputado_id", "ano"], ["_net"])
# columns of a document that the two marts read, its key and order included
READ = (
    "deputado_id", "cod_documento", "cod_lote", "cnpj_cpf_fornecedor", "ano", "mes", "data_documento",
    "valor_documento", "valor_glosa", "valor_liquido",
)


def spending_lines(feed: DataFrame, versions: DataFrame) -> DataFrame:
    """Changed documents as lines of ``SPENDING``."""
    documents = versioned.signed(feed).withColumnRenamed("deputado_id", "nk_deputado")
    documents = documents.withColumn("faixa_valor", rules.value_band("valor_liquido"))
    amount = F.col("valor_documento")
    bands = {
        name: F.when(F.col("faixa_valor") == label, amount).otherwise(F.lit(0))
        for name, label in marts.SPENDING_BANDS.items()
    }
    return marts.spending_lines(documents, versions).select(
        *SPENDING.keys, "_sign", amount.alias("_doc"), F.col("valor_liquido").alias("_net"),
        F.col("valor_glosa").alias("_cut"), *[c.alias(n) for n, c in bands.items()],
    )


def spending(totals: DataFrame, versions: DataFrame) -> DataFrame:
    """Spending per person version out of the kept totals: the same as ``marts.spend_per_person``."""
    sums = [ROWS, *SPENDING.sums]
    dealt = totals.repartition("nk_deputado")  # once for all that follows: a person's totals are one task's
    merged = dealt.groupBy(*marts.VERSION, "cod_documento", "_month").agg(
        *[F.sum(c).alias(c) for c in sums],
        F.min("data_documento").alias("_first"), F.max("data_documento").alias("_last"),
    )
    return marts.spending_of_documents(merged, versions)


def yearly_lines(feed: DataFrame) -> DataFrame:
    """Changed documents as lines of ``YEARLY``."""
    rows = versioned.signed(feed).where(F.col("valor_liquido") > 0)
    return rows.select("deputado_id", "ano", "_sign", F.col("valor_liquido").alias("_net"))


def ranking(totals: DataFrame, at_least_years: int = 2) -> DataFrame:
    """Persons ranked by spending out of the kept totals: the same as ``explore.spend_ranking``."""
    yearly = totals.select(
        "deputado_id", "ano", F.col(ROWS).alias("total_despesas"), F.col("_net").alias("valor_total_liquido"),
        ratio("_net", ROWS).alias("valor_medio_despesa"),
    )
    return explore.ranked_spenders(yearly, at_least_years)
