"""Web pages as WARC records in a table of chunks, written and read back as streams.

An archive is a folder of Parquet files whose rows are chunks: record identifier, chunk number,
bytes, and the digest of the payload up to and including the chunk. The chunks of one record, one
after the other, are the bytes of a WARC/1.1 record (header block, payload, two line ends), so
any reader or writer holds one chunk at a time. Of equal payloads only one is stored, in the
response record; the others are revisit records, which refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import frames, settled, shared_folder, table, whole

CHUNK = 64 << 10  # bytes of payload per row
LEAST = 0  # payloads of fewer bytes are always stored
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the name space of URLs
_CHUNKS = (
    "record_id string, chunk_no int, chunks int, page_id bigint, row_id bigint, "
    "record_type string, data binary, digest_so_far string"
)
_NAMES = [c.split()[0] for c in _CHUNKS.split(", ")]


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _one_line(value: object) -> str:
    text = value if isinstance(value, str) else ""
    return " ".join(text.split())


def header(kind: str, name: str, url: str, digest: str, size: int, refers_to: str | None) -> bytes:
    """WARC header block. A revisit has no payload but names its length and digest."""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{name}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {size}",
    ]
    if refers_to is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:uuid:{refers_to}>",
        ]
    lines += ["Content-Type: text/html", f"Content-Length: {0 if kind == 'revisit' else size}"]
    return "\r\n".join([*lines, "", ""]).encode("utf-8", "surrogatepass")


def record_name(page: int | None, row: int) -> str:
    """Identifier of a record; ``row`` tells rows of one page apart."""
    return str(uuid.uuid5(_NAMESPACE, f"{page}/{row}"))


def _decide(pages: DataFrame, least: int) -> DataFrame:
    """Which row answers for each payload: the smallest page_id, then the first such row.

    Payloads are equal if their SHA-1 and length are. Each payload's first row is an aggregate,
    joined back, so a payload that a third of all pages share is not gathered anywhere. The result
    is stored, with all that a record needs besides its payload: rows are numbered only once.
    """
    slim = settled(
        pages.select(
            F.monotonically_increasing_id().alias("row_id"),
            "page_id", "url", F.sha1("payload").alias("sha"), F.length("payload").alias("size"),
        )
    )
    first = slim.where(F.col("size") >= least).groupBy("sha", "size").agg(
        F.min_by(
            F.struct("page_id", "row_id"),
            F.struct(F.col("page_id").isNull(), F.col("page_id"), F.col("row_id")),
        ).alias("first")
    )
    own = F.col("first").isNull() | (F.col("first.row_id") == F.col("row_id"))
    return slim.join(first, ["sha", "size"], "left").select(
        "row_id", "page_id", "url", "sha", "size",
        F.when(~own, F.col("first.page_id")).alias("to_page"),
        F.when(~own, F.col("first.row_id")).alias("to_row"),
        F.when(own, "response").otherwise("revisit").alias("kind"),
    )


def write_archive(pages: DataFrame, path: str, chunk: int = CHUNK, least: int = LEAST) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) to a chunk table at ``path``.

    A null html counts as empty, a null url as empty; line ends in a url become spaces. Rows may
    repeat: every row gets a record of its own. Other columns are not read.

    Responses find their bytes by digest and length, not by a row's number in another scan;
    revisits need none.
    """
    rows = pages.select(F.col("page_id").cast("bigint"), "url", whole("html").cast("binary").alias("payload"))
    decided = _decide(rows, least)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def chunks() -> Iterator[tuple]:
            for part in parts:
                for page, url, payload, sha, size, row, to_page, to_row, kind in zip(
                    *[part[c] for c in ("page_id", "url", "payload", "sha", "size", "row_id", "to_page", "to_row", "kind")],
                    strict=True,
                ):
                    page = None if pd.isna(page) else int(page)
                    name = record_name(page, int(row))
                    other = None
                    if kind == "revisit":
                        other = record_name(None if pd.isna(to_page) else int(to_page), int(to_row))
                    head = header(kind, name, _one_line(url), base32(bytes.fromhex(sha)), int(size), other)
                    stored = memoryview(payload if kind == "response" else b"")
                    count = max(1, -(-len(stored) // chunk))
                    so_far = hashlib.sha1()
                    for no in range(count):
                        body = stored[no * chunk : (no + 1) * chunk]
                        so_far.update(body)
                        data = b"".join(
                            [head if no == 0 else b"", body, b"\r\n\r\n" if no == count - 1 else b""]
                        )
                        yield name, no, count, page, int(row), kind, data, base32(so_far.digest())

        for frame in frames(_NAMES, chunks(), 64):
            yield frame.astype({"page_id": "Int64"})

    digests = rows.select(F.sha1("payload").alias("sha"), F.length("payload").alias("size"), "payload")
    payloads = digests.groupBy("sha", "size").agg(F.first("payload").alias("payload"))
    responses = decided.where("kind = 'response'").join(payloads, ["sha", "size"])
    revisits = decided.where("kind = 'revisit'").withColumn("payload", F.lit(None).cast("binary"))
    responses.unionByName(revisits).mapInPandas(run, _CHUNKS).write.parquet(path)


_READ = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to string, intact boolean, record_id string"
)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of an archive, from its bytes alone.

    Records of one chunk are read where they lie. Those of several are brought together by record,
    sorted by chunk number and digested as a stream, so no payload is ever held as a whole.
    ``intact`` says whether bytes and digests agree with the header and all chunks are there.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def records() -> Iterator[tuple]:
            name = None
            for part in parts:
                for record, no, count, page, data, so_far in zip(
                    *[part[c] for c in ("record_id", "chunk_no", "chunks", "page_id", "data", "digest_so_far")],
                    strict=True,
                ):
                    if record != name or no == 0:  # a new record begins with its header
                        name, at, size, sha = record, 0, 0, hashlib.sha1()
                        top, _, rest = bytes(data).partition(b"\r\n\r\n")
                        lines = top.decode("utf-8", "surrogatepass").split("\r\n")
                        fields = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
                        good = no == 0
                    else:
                        rest = bytes(data)
                    body = rest[:-4] if no == count - 1 else rest
                    sha.update(body)
                    size += len(body)
                    good = good and no == at and base32(sha.digest()) == so_far
                    at += 1
                    if no != count - 1:
                        continue
                    kind = fields.get("WARC-Type", "")
                    digest = fields.get("WARC-Payload-Digest", "").removeprefix("sha1:")
                    good = good and size == int(fields.get("Content-Length", -1))
                    if kind == "response":
                        good = good and base32(sha.digest()) == digest
                        digest = base32(sha.digest())
                    else:
                        size = int(fields.get("X-Payload-Length", 0))
                    target = fields.get("WARC-Refers-To", "")[len("<urn:uuid:") : -1] or None
                    page = None if pd.isna(page) else int(page)
                    yield page, size, digest, kind, target, good, record

        for frame in frames([c.split()[0] for c in _READ.split(", ")], records()):
            yield frame.astype({"page_id": "Int64"})

    chunks = spark.read.schema(_CHUNKS).parquet(path)
    single = chunks.where("chunks = 1")
    many = (
        chunks.where("chunks > 1").repartition("record_id").sortWithinPartitions("record_id", "chunk_no")
    )
    return single.mapInPandas(run, _READ).union(many.mapInPandas(run, _READ))


def payload_chunks(spark: SparkSession, path: str, record: str) -> Iterator[bytes]:
    """The bytes of one record, chunk by chunk, as a driver-side stream."""
    rows = spark.read.schema(_CHUNKS).parquet(path).where(F.col("record_id") == record)
    for row in rows.orderBy("chunk_no").select("data").toLocalIterator():
        yield bytes(row["data"])


def archived(pages: DataFrame, path: str) -> DataFrame:
    """Write ``pages`` to ``path``, read the archive back and say what each record holds.

    ``refers_to`` is the page_id of the response that a revisit's header names. Empty tables give
    empty results, and a page without an id keeps its record.
    """
    spark = pages.sparkSession
    write_archive(pages, path)
    found = read_records(spark, path)
    targets = found.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"), F.col("page_id").alias("__target")
    )
    revisits = found.where("record_type = 'revisit'").join(targets, "refers_to", "left")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type"]
    return revisits.select(*columns, F.col("__target").alias("refers_to"), "intact").union(
        found.where("record_type <> 'revisit'").select(
            *columns, F.lit(None).cast("bigint").alias("refers_to"), "intact"
        )
    )


def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{shared_folder(spark)}/archive-{uuid.uuid4().hex}"
    return archived(table(spark, folder, "pages"), path)
