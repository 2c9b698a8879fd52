"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; one beside the warehouse where that is unset."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def settled(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of a slim result: computed once, survives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Parquet copy in the shared folder, for results too large for an uncompressed checkpoint."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole(text: str | Column = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def text_key(text: Column) -> Column:
    """Tells apart rows that share an id but not the text."""
    return F.xxhash64(text)


def texts(values: Iterable) -> list[str]:
    return [x if isinstance(x, str) else "" for x in values]


def bounded(df: DataFrame, rows: int, key: Column) -> DataFrame:
    """At most ``rows`` rows, chosen by the hash of a key: the sample that a model is fitted on."""
    return df.orderBy(F.xxhash64(key), key).limit(rows)


def frames(names: Sequence[str], rows: Iterator[tuple], at_a_time: int = 2000) -> Iterator[pd.DataFrame]:
    """Rows as pandas frames of bounded length."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= at_a_time:
            yield pd.DataFrame(held, columns=list(names))
            held = []
    if held:
        yield pd.DataFrame(held, columns=list(names))


def crc_of(values: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(values.astype("<u4").tobytes())
