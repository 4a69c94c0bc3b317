"""A content-addressed WARC archive: payload bytes once by digest, exact record headers apart.

Two tables make an archive: ``payloads`` (digest, payload), one row per distinct payload, and
``records`` (header, digest, ...), the header of each record as WARC text. Joined by digest they give
the records as they were; payloads are checked against their digest when they are read. The archive
can be written out as WARC files.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnguard.session import materialise

REVISIT_BYTES = 1000
CRLF = "\r\n"
#: All records carry this time unless a column is named: the tables have none.
EPOCH = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Archive:
    payloads: str
    records: str


def _record_id(page: Column) -> Column:
    """A stable identifier in the form of a UUID, from the page's id."""
    h = F.md5(F.concat(F.lit("page:"), F.coalesce(page.cast("string"), F.lit(""))))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _block_digest(kind: Column, digest: Column) -> Column:
    """Of a record's own block: that of a revisit is empty."""
    return F.when(kind == "revisit", F.sha2(F.lit(""), 256)).otherwise(digest)


def _header(kind: Column, date: Column) -> Column:
    """The header block of a record, up to and with its empty line."""

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))

    # A line break in a URL would end the header field.
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]+", " ")
    refers = F.when(
        kind == "revisit",
        F.concat(
            line("WARC-Profile", F.lit(PROFILE)),
            line("WARC-Refers-To", _record_id(F.col("refers_to"))),
            line("WARC-Refers-To-Page", F.col("refers_to").cast("string")),
        ),
    ).otherwise("")
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        line("WARC-Type", kind),
        line("WARC-Record-ID", _record_id(F.col("page_id"))),
        line("WARC-Date", date),
        line("WARC-Target-URI", url),
        line("WARC-Page", F.coalesce(F.col("page_id").cast("string"), F.lit(""))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        line("WARC-Block-Digest", F.concat(F.lit("sha256:"), _block_digest(kind, F.col("digest")))),
        line("WARC-Payload-Length", F.col("bytes").cast("string")),
        refers,
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(kind == "revisit", F.lit("0")).otherwise(F.col("bytes").cast("string"))),
        F.lit(CRLF),
    )


def write_archive(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    date_col: str | None = None,
    revisit_bytes: int = REVISIT_BYTES,
) -> Archive:
    """Stores ``pages`` in ``folder`` as an archive: a record per row.

    Of records whose payloads are equal and of at least ``revisit_bytes``, the one with the largest id
    is the response and the others revisit it; all smaller ones are responses. The payload is the
    column's text in UTF-8 or its bytes; null is empty. Rows that share an id and a payload share the
    response's rank: all with the largest id are responses. Rows without id come after all others and
    are the response only where no row has one. A null URL is empty; line breaks in it become spaces.
    Other columns are not stored. An empty table gives an empty archive.

    Equal payloads combine before the shuffle: each task sends a payload once, however many rows
    have it, and only digests and ids meet in the groups that may be hot.
    """
    payload = F.coalesce(F.encode(F.col(payload_col), "UTF-8") if dict(pages.dtypes)[payload_col] == "string" else F.col(payload_col), F.encode(F.lit(""), "UTF-8"))
    date = F.col(date_col).cast("string") if date_col else F.lit(EPOCH)
    source = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(date, F.lit(EPOCH)).alias("date"),
        payload.alias("payload"),
    )
    digest = F.sha2("payload", 256)
    payloads = source.select(digest.alias("digest"), "payload").groupBy("digest").agg(F.first("payload").alias("payload"))
    payloads.write.parquet(f"{folder}/payloads")
    heads = source.select(
        "page_id", "url", "date", digest.alias("digest"), F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("bytes")
    )
    response = heads.where(F.col("bytes") >= revisit_bytes).groupBy("digest").agg(F.max("page_id").alias("refers_to"))
    # Joined straight from the aggregation, the rows of a hot payload would stay in one task.
    joined = heads.join(materialise(response), "digest", "left")
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    kind = F.when(revisit, "revisit").otherwise("response")
    records = joined.withColumn("refers_to", F.when(revisit, F.col("refers_to")))
    records.select(_header(kind, F.col("date")).alias("header"), "digest").write.parquet(f"{folder}/records")
    return Archive(f"{folder}/payloads", f"{folder}/records")


def _field(name: str) -> Column:
    return F.regexp_extract("header", rf"\n{name}: ([^\r\n]*)\r\n", 1)


def read_archive(spark: SparkSession, archive: Archive) -> DataFrame:
    """The records: (page_id, url, date, record_type, refers_to, header, payload, payload_bytes,
    payload_digest, verified).

    Digests and lengths are taken from the stored payload, once for each, not from the header;
    ``verified`` says whether both agree with the header. A record whose payload is missing has a null
    payload and is not verified.
    """
    stored = spark.read.parquet(archive.payloads).select(
        F.col("digest"),
        "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"),
        (F.sha2("payload", 256) == F.col("digest")).alias("whole"),
    )
    records = spark.read.parquet(archive.records).select(
        "header",
        "digest",
        _field("WARC-Page").alias("page"),
        _field("WARC-Target-URI").alias("url"),
        _field("WARC-Date").alias("date"),
        _field("WARC-Type").alias("record_type"),
        _field("WARC-Refers-To-Page").alias("refers"),
        _field("WARC-Payload-Digest").alias("said_sha1"),
        _field("WARC-Block-Digest").alias("said_digest"),
        _field("WARC-Payload-Length").alias("said_bytes"),
    )
    verified = (
        F.col("whole")
        & (F.col("said_digest") == F.concat(F.lit("sha256:"), _block_digest(F.col("record_type"), F.col("digest"))))
        & (F.col("said_sha1") == F.concat(F.lit("sha1:"), F.col("payload_digest")))
        & (F.col("said_bytes") == F.col("payload_bytes").cast("string"))
    )
    return records.join(stored, "digest", "left").select(
        F.expr("try_cast(nullif(page, '') AS bigint)").alias("page_id"),
        "url",
        "date",
        "record_type",
        F.expr("try_cast(nullif(refers, '') AS bigint)").alias("refers_to"),
        "header",
        "payload",
        "payload_bytes",
        "payload_digest",
        F.coalesce(verified, F.lit(False)).alias("verified"),
    )


def reconstruct(spark: SparkSession, archive: Archive) -> DataFrame:
    """(page_id, record): each record's exact bytes, header and payload (none in revisits), as WARC
    files hold them."""
    found = read_archive(spark, archive)
    body = F.when(F.col("record_type") == "revisit", F.encode(F.lit(""), "UTF-8")).otherwise(F.col("payload"))
    end = F.encode(F.lit(CRLF * 2), "UTF-8")
    return found.select("page_id", F.concat(F.encode("header", "UTF-8"), body, end).alias("record"))


def export_warc(spark: SparkSession, archive: Archive, folder: str, records_per_file: int = 50_000) -> None:
    """Writes the records as WARC files, gzipped, by Spark's text writer; for payloads in UTF-8."""
    lines = reconstruct(spark, archive).select(F.decode("record", "UTF-8").alias("value"))
    # Each record ends with the two line breaks that the writer adds.
    cut = lines.select(F.expr("substring(value, 1, length(value) - 4)").alias("value"))
    writer = cut.write.option("lineSep", CRLF * 2).option("compression", "gzip")
    writer.option("maxRecordsPerFile", records_per_file).text(folder)


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """(header, block) of each record in gzipped WARC files; a file is read by one task, record by record."""
    return spark.read.format("binaryFile").load(folder).select("content").mapInArrow(_split, "header string, block binary")


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import gzip
    import io

    for batch in batches:
        for content in batch.column(0):
            stream = gzip.GzipFile(fileobj=io.BytesIO(content.as_py()))
            rows: list[tuple[str, bytes]] = []
            size = 0
            while first := stream.readline():
                if not first.strip():
                    continue
                header, length = [first], 0
                while (line := stream.readline()) not in (b"\r\n", b""):
                    header.append(line)
                    if line.lower().startswith(b"content-length:"):
                        length = int(line.split(b":", 1)[1])
                rows.append((b"".join(header).decode() + CRLF, stream.read(length)))
                size += length
                if size > 8 << 20:
                    yield _rows(rows)
                    rows, size = [], 0
            if rows:
                yield _rows(rows)


def _rows(rows: list[tuple[str, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary())], ["header", "block"]
    )
