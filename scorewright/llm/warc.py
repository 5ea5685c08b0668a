"""WARC archives: pages written as request, response or revisit, and metadata records; captures read back.

Writing. Payloads are told apart by their SHA-256; the page of the smallest id among equal payloads is the
response, the others are revisits that refer to its record. A record is one line of Spark's text writer
with the two line ends that close a WARC record as separator, so archives are valid, go to any file system
that Spark writes to, and appear only when their task commits.

Reading. A task parses whole archives by their Content-Length. The records of one capture name each other
through WARC-Concurrent-To: they are joined on the identifier of the response or revisit, in one shuffle,
into one nested row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the format.
END = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads of fewer bytes are never revisits.
MIN_REVISIT = 100
#: Captures of one archive, so that a reader's task holds a bounded file.
CAPTURES = 5_000


def _headers(*pairs: tuple[str, Column | str]) -> Column:
    """Header lines; a null value leaves its line out."""
    lines = [F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit(END)) for name, value in pairs]
    return F.concat(F.lit(f"WARC/1.1{END}"), *[F.coalesce(x, F.lit("")) for x in lines])


def _record(block: Column, *pairs: tuple[str, Column | str]) -> Column:
    size = F.octet_length(block).cast("string")
    return F.concat(_headers(*pairs, ("Content-Length", size)), F.lit(END), block)


def _record_id(capture: Column, kind: str) -> Column:
    return F.concat(F.lit("<urn:capture:"), capture, F.lit(f":{kind}>"))


def write_archives(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Archives of all pages (page_id, url, html) in the folder `path`.

    A null html is an empty payload, a null url leaves the target out; a null page_id is written as
    `null`, sorts last, and refers like any other. Rows that repeat an id, even whole rows, are captures of
    their own; of equal payloads under one smallest id the first by url and place is the response. Other
    columns are ignored, whatever their names. The input should be a scan or a written table, as its rows
    are told apart by their place. An empty table gives a folder without records.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace("url", r"[\x00-\x20]", "%20").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    ).withColumn("place", F.monotonically_increasing_id())
    rows = rows.withColumn("capture", F.concat_ws(".", F.coalesce(F.col("page_id").cast("string"), F.lit("null")), "place"))
    size = F.octet_length("html")
    keys = rows.select("page_id", "place", "capture", F.sha2("html", 256).alias("digest"), size.alias("size"))
    firsts = (
        keys.filter(F.col("size") >= MIN_REVISIT)
        .groupBy("digest")
        .agg(F.min(F.struct(F.col("page_id").isNull(), "page_id", "place", "capture")).alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("digest", F.col("first.capture").alias("original"))
    )
    rows = rows.withColumn("digest", F.sha2("html", 256)).join(firsts, "digest", "left")
    revisit = F.coalesce(F.col("original") != F.col("capture"), F.lit(False))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), size.cast("string"), F.lit(END + END))
    main_id = F.when(revisit, _record_id(F.col("capture"), "revisit")).otherwise(_record_id(F.col("capture"), "response"))
    common = (("WARC-Date", date), ("WARC-Target-URI", F.col("url")))
    request = _record(
        F.concat(F.lit("GET "), F.coalesce("url", F.lit("/")), F.lit(f" HTTP/1.1{END}{END}")),
        ("WARC-Type", "request"), ("WARC-Record-ID", _record_id(F.col("capture"), "request")), *common,
        ("WARC-Concurrent-To", main_id), ("Content-Type", "application/http;msgtype=request"),
    )
    main = _record(
        F.when(revisit, http).otherwise(F.concat(http, "html")),
        ("WARC-Type", F.when(revisit, "revisit").otherwise("response")), ("WARC-Record-ID", main_id), *common,
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        ("WARC-Profile", F.when(revisit, PROFILE)), ("WARC-Refers-To", F.when(revisit, _record_id(F.col("original"), "response"))),
        ("Content-Type", "application/http;msgtype=response"),
    )
    metadata = _record(
        F.concat(F.lit("page_id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.lit(END)),
        ("WARC-Type", "metadata"), ("WARC-Record-ID", _record_id(F.col("capture"), "metadata")), *common,
        ("WARC-Concurrent-To", main_id), ("Content-Type", "application/warc-fields"),
    )
    rows.select(F.explode(F.array(request, main, metadata)).alias("value")).write.option(
        "lineSep", END + END
    ).option("maxRecordsPerFile", 3 * CAPTURES).option("compression", "gzip").text(path)


_RECORDS = "type string, record_id string, concurrent_to string, refers_to string, target_uri string, declared string, http_length long, fields string, payload binary"


def _parsed(data: bytes) -> Iterator[tuple]:
    """Records of one archive, in the order of _RECORDS."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split(END)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at byte {at}")
        h = {name.lower(): value for name, _, value in (x.partition(": ") for x in lines[1:])}
        block = data[end + 4 : end + 4 + int(h["content-length"])]
        at = end + 8 + len(block)
        kind, length, fields, payload = h["warc-type"], None, None, None
        if kind in ("response", "revisit"):
            head, _, body = block.partition(b"\r\n\r\n")
            for line in head.decode().split(END)[1:]:
                name, _, value = line.partition(": ")
                if name.lower() == "content-length":
                    length = int(value)
            payload = body if kind == "response" else None
        elif kind == "metadata":
            fields = block.decode()
        yield kind, h["warc-record-id"], h.get("warc-concurrent-to"), h.get("warc-refers-to"), h.get("warc-target-uri"), h.get("warc-payload-digest"), length, fields, payload


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives in a folder, gzip members or plain."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string()] * 6 + [pa.int64(), pa.string(), pa.binary()]
        names = [x.split()[0] for x in _RECORDS.split(", ")]
        for batch in batches:
            for k in range(batch.num_rows):
                data = batch.column("content")[k].as_py()
                plain = []
                while data[:2] == b"\x1f\x8b":
                    member = zlib.decompressobj(31)
                    plain.append(member.decompress(data) + member.flush())
                    data = member.unused_data
                rows = []
                for row in _parsed(b"".join(plain) or data):
                    rows.append(row)
                    if len(rows) == 500:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content").mapInArrow(parse, _RECORDS)


def assemble_captures(records: DataFrame, payload: bool = True) -> DataFrame:
    """One nested row per capture: record_id, type, refers_to, target_uri, payload_digest, payload_bytes,
    requests and metadata (arrays of structs), and the payload unless it isn't wanted.

    Digest and size are computed from a response's payload as read; a revisit has those it declares. A
    request or metadata record whose response is missing makes a row with a null type. Repeated records
    stay repeated in the arrays; of repeated responses with one identifier one stays.
    """
    main = F.col("type").isin("response", "revisit")
    digest = F.when(F.col("type") == "response", F.sha2("payload", 256)).otherwise(F.regexp_replace("declared", "^sha256:", ""))
    size = F.when(F.col("type") == "response", F.octet_length("payload")).otherwise(F.col("http_length"))
    parts = ["type", "refers_to", "target_uri", digest.alias("payload_digest"), size.cast("long").alias("payload_bytes")]
    if payload:
        parts.append("payload")
    rows = records.select(
        F.when(main, F.col("record_id")).otherwise(F.col("concurrent_to")).alias("record_id"),
        F.when(main, F.struct(*parts)).alias("main"),
        F.when(F.col("type") == "request", F.struct(F.col("record_id").alias("id"), "target_uri")).alias("request"),
        F.when(F.col("type") == "metadata", F.struct(F.col("record_id").alias("id"), "fields")).alias("metadata"),
    )
    return rows.groupBy("record_id").agg(
        F.first("main", ignorenulls=True).alias("main"), F.collect_list("request").alias("requests"), F.collect_list("metadata").alias("metadata")
    ).select("record_id", "main.*", "requests", "metadata")
