"""Documents whose fields change type or move between levels, read as VARIANT."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(df: DataFrame, text: str, out: str = "documento") -> DataFrame:
    """JSON text as VARIANT; text that is no JSON becomes NULL."""
    return df.withColumn(out, F.try_parse_json(text))


def field(document: str | Column, paths: Sequence[str], kind: str) -> Column:
    """The first of several paths that holds a value which fits the type; NULL if none does."""
    return F.coalesce(*[F.try_variant_get(document, path, kind) for path in paths])


def typed(df: DataFrame, document: str, fields: Mapping[str, tuple[Sequence[str], str]]) -> DataFrame:
    """Flat typed table: output name to (paths in order of preference, type)."""
    others = [c for c in df.columns if c != document]
    return df.select(*others, *[field(document, paths, kind).alias(name) for name, (paths, kind) in fields.items()])


def drift(df: DataFrame, document: str, expected: Mapping[str, str]) -> DataFrame:
    """Per path and type found there: rows, and whether that type was expected.

    ``expected`` maps paths to the type names of ``schema_of_variant`` (``BIGINT``, ``STRING``, ...),
    several of them parted by ``|``. A path that is absent counts as ``AUSENTE``. Rows are counted
    by (path, type), so the report stays small however many documents there are.
    """
    found = F.array(
        *[
            F.struct(
                F.lit(path).alias("caminho"),
                F.regexp_replace(
                    F.coalesce(F.schema_of_variant(F.try_variant_get(document, path, "variant")), F.lit("AUSENTE")), r"\(.*", ""
                ).alias("tipo"),
                F.lit(kinds).alias("esperado"),
            )
            for path, kinds in expected.items()
        ]
    )
    counted = df.select(F.explode(found).alias("x")).groupBy("x.caminho", "x.tipo", "x.esperado").agg(
        F.count(F.lit(1)).alias("linhas")
    )
    return counted.select("*", F.array_contains(F.split("esperado", r"\|"), F.col("tipo")).alias("conforme"))


def common_schema(df: DataFrame, document: str) -> DataFrame:
    """One row: the schema that all documents fit into, VARIANT where types differ."""
    return df.agg(F.schema_of_variant_agg(document).alias("esquema"))
