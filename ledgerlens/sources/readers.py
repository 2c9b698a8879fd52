"""Scans: typed Parquet, JSON documents, delimited text, and nested-path projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import schemas
from ledgerlens.functions.keys import number_after
from ledgerlens.operators.lineage import materialize


def read_parquet(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None
) -> DataFrame:
    """Typed scan; the schema is given, never inferred from the data rows."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    return read_parquet(spark, path, schemas.schema(table))


def read_json_documents(
    spark: SparkSession, path: str, schema: T.StructType, array: str = "dados",
    whole_file: bool = True,
) -> DataFrame:
    """One row per element of the array inside each JSON document, with the file path.

    A document that spans lines makes its file one task; with one document per line, say
    ``whole_file=False``, and large files are split.
    """
    documents = spark.read.schema(schema).json(path, multiLine=whole_file)
    return documents.select(
        F.col("_metadata.file_path").alias("arquivo"), F.inline(F.col(array))
    )


def read_seed(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Small reference table: quoted, ``;``-separated, UTF-8 with or without byte-order mark."""
    wanted = schemas.schema(table)
    raw = spark.read.csv(path, sep=";", header=True, quote='"', encoding="UTF-8")
    bare = {c: c.lstrip("﻿").strip('"') for c in raw.columns}
    return align(raw.withColumnsRenamed(bare), wanted)


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = ";",
    bad_rows: str = "drop",
) -> DataFrame:
    """Delimited text. ``bad_rows``: ``drop`` skips malformed lines, ``keep`` puts their text into
    ``_corrupt_record`` for a quarantine table, ``fail`` stops."""
    mode = {"drop": "DROPMALFORMED", "keep": "PERMISSIVE", "fail": "FAILFAST"}[bad_rows]
    if bad_rows == "keep":
        schema = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(schema).csv(path, sep=sep, header=True, mode=mode)


def listing_rows(df: DataFrame, out: str = "linha") -> DataFrame:
    """Number of every row of a listing, from 1, in the order of its files and of the rows in them.

    Files are counted apart: a file's rows are numbered where they lie, by the bytes at which Spark's
    splits begin, and shifted by the rows of the splits before. One small row per split carries that.
    """
    place = F.struct(F.col("_metadata.file_name").alias("f"), F.col("_metadata.file_block_start").alias("b"))
    rows = df.select("*", place.alias("_place"), F.monotonically_increasing_id().alias("_at"))
    rows = materialize(rows, "listing")
    split = rows.groupBy("_place").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    shift = split.select("_place", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    return rows.join(shift, "_place").select(*df.columns, (F.col("_at") + F.col("_shift")).alias(out))


def safe_cast(c: Column, kind: str, source: T.DataType | None = None) -> Column:
    """Cast that yields NULL for a value that does not fit; arrays become comma-joined text."""
    if isinstance(source, T.ArrayType):
        return F.array_join(c, ", ")
    if kind == "boolean" and not isinstance(source, T.BooleanType):
        text = F.lower(c.cast("string"))
        return F.coalesce(text.isin("1", "true", "1.0"), F.lit(False))
    return c.try_cast(kind)


def project(df: DataFrame, spec: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Flat typed table from nested rows: output name to (dotted path, type)."""
    picked = []
    for name, (path, kind) in spec.items():
        source = _type_at(df.schema, path)
        picked.append(safe_cast(F.col(path), kind, source).alias(name))
    return df.select(*picked)


def load(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Landed Parquet files of a table, projected onto its typed columns."""
    return project(spark.read.parquet(path), schemas.projection(table))


def align(df: DataFrame, wanted: T.StructType) -> DataFrame:
    """Match columns by name without regard to case; add missing ones as NULL, drop the rest."""
    have = {c.lower(): c for c in df.columns}
    out = []
    for field in wanted.fields:
        source = have.get(field.name.lower())
        kind = field.dataType.simpleString()
        value = F.lit(None).cast(kind) if source is None else F.col(f"`{source}`").try_cast(kind)
        out.append(value.alias(field.name))
    return df.select(*out)


def flatten(df: DataFrame, separator: str = "_") -> DataFrame:
    """All leaf fields of nested structs as columns, named by their path."""

    def leaves(fields: list[T.StructField], path: tuple[str, ...]) -> list[Column]:
        out = []
        for f in fields:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                out += leaves(f.dataType.fields, here)
            else:
                out.append(F.col(".".join(f"`{p}`" for p in here)).alias(separator.join(here)))
        return out

    return df.select(*leaves(df.schema.fields, ()))


def json_fields(df: DataFrame, text: str, schema: str | T.StructType, prefix: str = "") -> DataFrame:
    """Fields of a JSON text column as columns."""
    parsed = df.withColumn("_json", F.from_json(F.col(text), schema))
    names = parsed.schema["_json"].dataType.names
    return parsed.select(
        *df.columns, *[F.col(f"_json.{n}").alias(f"{prefix}{n}") for n in names]
    )


def with_file_context(df: DataFrame, **markers: str) -> DataFrame:
    """Numbers out of the file path, such as ``deputado_id="deputado="``."""
    path = F.col("_metadata.file_path")
    return df.select("*", *[number_after(path, m).alias(n) for n, m in markers.items()])


def with_context(df: DataFrame, **values: object) -> DataFrame:
    """Constant columns that say which request the rows came from."""
    return df.withColumns({n: F.lit(v) for n, v in values.items()})


def _type_at(schema: T.StructType, path: str) -> T.DataType:
    kind: T.DataType = schema
    for part in path.split("."):
        by_name = {f.name.lower(): f.dataType for f in kind.fields}
        kind = by_name[part.lower()]
    return kind
