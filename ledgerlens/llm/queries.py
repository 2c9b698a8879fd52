"""Queries of this subpackage by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import manifest, middle, passages
from ledgerlens.llm.merkle import op10_merkle
from ledgerlens.llm.mixing import op6_mixing
from ledgerlens.llm.neighbours import op9_neighbours
from ledgerlens.llm.packing import op3_packing
from ledgerlens.llm.pii import op2_pii
from ledgerlens.llm.quality import op7_quality
from ledgerlens.llm.repeats import op5_repeats
from ledgerlens.llm.simhash import op1_simhash
from ledgerlens.llm.toxicity import op8_toxicity
from ledgerlens.llm.warc import op4_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_pii": op2_pii,
    "op3_packing": op3_packing,
    "op4_warc": op4_warc,
    "op5_repeats": op5_repeats,
    "op6_mixing": op6_mixing,
    "op7_quality": op7_quality,
    "op8_toxicity": op8_toxicity,
    "op9_neighbours": op9_neighbours,
    "op10_merkle": op10_merkle,
    "op11_manifest": manifest.op11_manifest,
    "op12_passages": passages.op12_passages,
    "op13_middle": middle.op13_middle,
}

ORACLE_SQL: dict[str, str] = {
    "op11_manifest": manifest.ORACLE,
    "op12_passages": passages.ORACLE,
    "op13_middle": middle.ORACLE,
}
