"""Content-addressed WARC archive of pages.

Of equal payloads of some length only one is stored, named by its SHA-256; records that repeat it
are revisits, which hold headers only. The archive is a folder of gzipped WARC files that Spark's
text writer makes, one per task, so a lost task is written again as a whole. Reading parses the
files by their Content-Length, checks every payload against its digest, and keeps exact record
headers apart from payloads; joins on the digest give the original records back.

In writing, payloads never move by digest, where a hot one would gather: pages are shuffled by
``page_id``, and only ids, urls and digests meet per digest. The first page of each digest is a
written table, so that adaptive execution can split the revisits of a hot one over several tasks and
files. In reading, a payload moves once per part of its revisits.

Null html is an empty payload, a null url leaves its header out, and line ends in a url are
percent-encoded. Rows with a null ``page_id`` are responses that nobody refers to. Repeated rows of
the smallest page are all responses. An archive of no pages has no records. Long payloads are kept
whole; one record must fit in a task. Other columns of ``pages``, whatever they are called, are not
looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from gzip import GzipFile
from io import BufferedReader, BytesIO
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_folder
from .common import small_batches, stage

MIN_SHARED_BYTES = 100
DATE = "1970-01-01T00:00:00Z"  # pages carry no time of their own
END = "\r\n"
BATCH_BYTES = 8 << 20
FILE_RECORDS = 20_000
MAX_HOT = 4096  # digests that are dealt to parts
LEAST_HOT = 256  # revisits in a part, at least

RECORD = ("page_id long, record_type string, refers_to long, payload_digest string, "
          "payload_bytes long, header string")


def _header(kind: Column, page: Column, url: Column, digest: Column, length: Column,
            refers: Column) -> Column:
    safe = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat_ws(
        END, F.lit("WARC/1.1"), F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"),
                 F.coalesce(page.cast("string"), F.lit("null")), F.lit(">")),
        F.lit(f"WARC-Date: {DATE}"), F.concat(F.lit("WARC-Target-URI: "), safe),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), digest),
        F.concat(F.lit("WARC-Refers-To: <urn:page:"), refers.cast("string"), F.lit(">")),
        F.lit("Content-Type: text/html"),
        F.concat(F.lit("Content-Length: "), length.cast("string")))


def write_archive(pages: DataFrame, folder: str, min_shared: int = MIN_SHARED_BYTES) -> None:
    """A WARC record for each row of ``pages`` (page_id, url, html) below ``folder``."""
    whole = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("payload")) \
                 .withColumns({"digest": F.sha2("payload", 256),
                               "bytes": F.octet_length("payload").cast("bigint")})
    named = whole.select("page_id", "url", "digest", "bytes")
    firsts = stage(named.where((F.col("bytes") >= min_shared) & F.col("page_id").isNotNull())
                   .groupBy("digest").agg(F.min("page_id").alias("first")), "warc-firsts")
    stored = firsts.select(F.col("first").alias("kept"), F.col("digest").alias("kept_digest"))
    responses = whole.join(
        stored, (F.col("page_id") == F.col("kept")) & (F.col("digest") == F.col("kept_digest")),
        "left").where((F.col("bytes") < min_shared) | F.col("page_id").isNull()
                      | F.col("kept").isNotNull())
    revisits = named.where(F.col("bytes") >= min_shared).join(firsts, "digest") \
                    .where("page_id <> first")
    none = F.lit(None).cast("bigint")
    records = responses.select(F.concat(
        _header(F.lit("response"), F.col("page_id"), F.col("url"), F.col("digest"),
                F.col("bytes"), none), F.lit(END + END), "payload").alias("value")).unionAll(
        revisits.select(F.concat(
            _header(F.lit("revisit"), F.col("page_id"), F.col("url"), F.col("digest"),
                    F.lit(0), F.col("first")), F.lit(END + END)).alias("value")))
    records.write.option("lineSep", END + END).option("compression", "gzip") \
           .option("maxRecordsPerFile", FILE_RECORDS).text(folder)


def _records(stream: BinaryIO) -> Iterator[tuple]:
    """The records of one WARC file, read one by one: the columns of RECORD and the payload."""
    while line := stream.readline():
        lines = []
        while line != b"\r\n":
            if not line:
                raise ValueError("a WARC file ends within a header")
            lines.append(line)
            line = stream.readline()
        header = b"".join(lines).decode().removesuffix(END)
        fields = dict(line.split(": ", 1) for line in header.split(END)[1:])
        payload = stream.read(int(fields["Content-Length"]))
        if stream.read(4) != b"\r\n\r\n":
            raise ValueError("a WARC record is longer or shorter than its Content-Length")
        kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha256:")
        if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"the payload of {fields['WARC-Record-ID']} does not fit its digest")

        def page(name: str) -> int | None:
            value = fields.get(name, "<urn:page:null>")[len("<urn:page:"):-1]
            return None if value == "null" else int(value)

        yield (page("WARC-Record-ID"), kind, page("WARC-Refers-To"), digest,
               len(payload) if kind == "response" else None, header, payload)


def parse_archive(spark: SparkSession, folder: str, payloads: bool) -> DataFrame:
    """Every record of the archive: the columns of RECORD, and ``payload`` if asked for.

    A file holds at most FILE_RECORDS records of what one task wrote. Its compressed bytes are read
    whole and unpacked record by record.
    """
    width = 7 if payloads else 6
    schema = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()),
                        ("refers_to", pa.int64()), ("payload_digest", pa.string()),
                        ("payload_bytes", pa.int64()), ("header", pa.string()),
                        ("payload", pa.binary())][:width])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for content in batch.column("content"):
                for record in _records(BufferedReader(GzipFile(fileobj=BytesIO(content.as_py())))):
                    rows.append(record[:width])
                    size += len(record[6]) + len(record[5])
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)],
                            schema=schema)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    small_batches(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
    return files.select("content").mapInArrow(
        parse, RECORD + (", payload binary" if payloads else ""))


def read_headers(spark: SparkSession, folder: str) -> DataFrame:
    """The exact headers of all records, staged as a table apart from the payloads, with the
    verified length of the payloads that are there."""
    return stage(parse_archive(spark, folder, payloads=False), "warc-headers")


def rebuild(spark: SparkSession, folder: str, headers: DataFrame) -> DataFrame:
    """The original records of the archive: the columns of RECORD and each record's full payload,
    by which a revisit's digest and length are computed anew. Responses hold their own; revisits,
    whose headers come from ``headers``, get that of the response of their digest. Revisits of a
    hot digest are dealt to parts of bounded size, each with a copy of the payload."""
    responses = parse_archive(spark, folder, payloads=True).where("record_type = 'response'")
    revisits = headers.where("record_type = 'revisit'")
    per = LEAST_HOT + revisits.count() // MAX_HOT
    shared = revisits.groupBy("payload_digest").agg(
        F.ceil(F.count("*") / per).alias("parts"))
    hot = shared.where("parts > 1")
    dealt = revisits.join(F.broadcast(hot), "payload_digest", "left").withColumn(
        "part", F.pmod(F.monotonically_increasing_id(), F.coalesce("parts", F.lit(1))))
    payloads = responses.select("payload_digest", "payload") \
        .dropDuplicates(["payload_digest"]).join(shared, "payload_digest") \
        .select("payload_digest", "payload",
                F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))
    full = dealt.join(payloads, ["payload_digest", "part"], "left").withColumn(
        "payload", F.coalesce("payload", F.raise_error(F.concat(
            F.lit("no response holds the payload "), F.col("payload_digest"))).cast("binary")))
    rebuilt = full.withColumns({
        "payload_digest": F.sha2("payload", 256),
        "payload_bytes": F.octet_length("payload").cast("bigint")})
    return responses.unionAll(rebuilt.select(*responses.columns))


def archive_pages(pages: DataFrame) -> tuple[str, DataFrame]:
    """Write ``pages`` to a new archive in the shared folder; its path and rebuilt records."""
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    write_archive(pages, folder)
    return folder, rebuild(spark, folder, read_headers(spark, folder))
