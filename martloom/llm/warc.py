"""WARC archives written from pages and read back as one nested row per capture.

Each page becomes three records: a request, a response (or, for a payload that another page holds
too, a revisit that refers to that response) and a metadata record. Request and metadata name the
main record in ``WARC-Concurrent-To``; reading parses the archives by their content lengths, joins
the records of a capture through those identifiers and returns one nested row per capture.

Archives are gzip files of whole WARC records, written by Spark's own text writer with a newline as
separator: a record ends in CR LF CR LF, whose last byte is that separator. They can therefore lie
in any store that Spark reaches. Reading holds one archive file per task at a time; files are as
large as the shuffle partitions that they are written from.

Equal payloads are found by their SHA-1 over slim rows without the html; a hot payload only meets a
map-side combined maximum and a join that adaptive execution may split. What results, the pages with a
payload that others hold too, is joined to the html: sent to it if the planner finds it small, else by a
shuffle of the html.

Defined results: null html is an empty payload, a null url has no target URI, repeated rows of a page
are captures of their own (the first is the response, the others revisit it), null page ids count as
smaller than all others, an empty table gives no rows, further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..workspace import stage

# Fixed values of the WARC format and of RFC 4648's base32 alphabet.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DIGITS_32, BASE_32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CRLF = "\r\n"


def sha1_base32(data: Column) -> Column:
    """SHA-1 as base32, in built-in functions: 160 bits are four groups of eight 5-bit digits."""
    digest = F.upper(F.sha1(data.cast("binary")))
    groups = [F.lpad(F.conv(F.substring(digest, i, 10), 16, 32), 8, "0") for i in (1, 11, 21, 31)]
    return F.translate(F.upper(F.concat(*groups)), DIGITS_32, BASE_32)


def _record(kind: str, record_id: Column, headers: list[Column], block: Column) -> Column:
    """One record as text; a header column that is null is left out."""
    length = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))
    head = F.concat_ws(
        CRLF,
        F.lit(VERSION),
        F.lit(f"WARC-Type: {kind}"),
        F.concat(F.lit("WARC-Record-ID: "), record_id),
        *headers,
        length,
    )
    return F.concat(head, F.lit(CRLF * 2), block, F.lit(CRLF * 2))


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), F.regexp_replace(value, r"[\r\n]", ""))


def captures(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Pages with digest, record ids and the page that their payload refers to, if another's."""
    url = F.col("url").cast("string")
    body = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), url.alias("url"), body.alias("html")
    ).withColumns({"digest": sha1_base32(F.col("html")), "payload_bytes": F.octet_length("html").cast("long")})
    slim = rows.select("page_id", "digest", "payload_bytes")
    shared = (
        slim.groupBy("digest")
        .agg(
            F.max("page_id").alias("winner"),
            (F.max("payload_bytes") >= min_revisit_bytes).alias("_large"),
            F.count(F.lit(1)).alias("_copies"),
        )
        .where("_copies > 1")
        .select("digest", "winner", "_large")
    )
    # A written table, so that the planner knows its size: small, it goes to the pages; otherwise both
    # sides are shuffled by page and digest.
    refers = stage(
        slim.join(shared, "digest")
        .groupBy(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"))
        .agg(
            F.max("winner").alias("winner"),
            F.max("_large").alias("_large"),
            (F.count(F.lit(1)) > 1).alias("_repeated"),
        ),
        "refers",
    )
    joined = rows.join(
        refers, F.col("page_id").eqNullSafe(F.col("_page")) & (F.col("digest") == F.col("_digest")), "left"
    )
    repeated = F.coalesce(F.col("_repeated"), F.lit(False))
    numbered = joined.where(~repeated).withColumn("_copy", F.lit(1))
    if refers.where("_repeated").limit(1).count():
        order = Window.partitionBy("page_id", "digest").orderBy("url")
        numbered = numbered.unionByName(joined.where(repeated).withColumn("_copy", F.row_number().over(order)))
    name = lambda page, digest, k: F.concat(
        F.lit("<urn:capture:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(":"), digest, F.lit(":"), k.cast("string")
    )
    first = F.col("winner").eqNullSafe(F.col("page_id")) & (F.col("_copy") == 1)
    return numbered.select(
        "page_id",
        "url",
        "html",
        "digest",
        "payload_bytes",
        F.concat(name(F.col("page_id"), F.col("digest"), F.col("_copy"))).alias("capture"),
        F.when(
            F.coalesce(F.col("_large"), F.lit(False)) & ~first, name(F.col("winner"), F.col("digest"), F.lit(1))
        ).alias("refers_to"),
    )


def records(rows: DataFrame, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """The three records of each capture as one text value."""
    part = lambda kind, base: F.concat(base, F.lit(f":{kind}>"))
    main = part("main", F.col("capture"))
    uri = _header("WARC-Target-URI", F.col("url"))
    when = F.lit(f"WARC-Date: {date}")
    concurrent = F.concat(F.lit("WARC-Concurrent-To: "), main)
    digest = F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"))
    http = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    request = _record(
        "request",
        part("request", F.col("capture")),
        [concurrent, uri, when, F.lit("Content-Type: application/http; msgtype=request")],
        F.lit("GET / HTTP/1.1\r\nUser-Agent: archive\r\n\r\n"),
    )
    response = _record(
        "response", main, [uri, when, digest, F.lit("Content-Type: application/http; msgtype=response")],
        F.concat(http, F.col("html")),
    )
    revisit = _record(
        "revisit",
        main,
        [
            uri,
            when,
            digest,
            F.concat(F.lit("WARC-Refers-To: "), part("main", F.col("refers_to"))),
            F.lit(f"WARC-Profile: {REVISIT_PROFILE}"),
            F.lit("Content-Type: application/http; msgtype=response"),
        ],
        http,
    )
    metadata = _record(
        "metadata",
        part("metadata", F.col("capture")),
        [concurrent, uri, when, F.lit("Content-Type: application/warc-fields")],
        F.concat(
            F.lit("pageId: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
            F.lit("\r\npayloadBytes: "), F.col("payload_bytes").cast("string"), F.lit(CRLF),
        ),
    )
    whole = F.concat(request, F.when(F.col("refers_to").isNull(), response).otherwise(revisit), metadata)
    return rows.select(whole.alias("whole")).select(F.expr("left(whole, length(whole) - 1)").alias("value"))


def write(rows: DataFrame, path: str) -> None:
    """Write captures as gzip archives; ``rows`` as ``captures`` returns them."""
    records(rows).write.option("lineSep", "\n").option("compression", "gzip").text(path)


class _Source:
    """Bytes of an archive, decompressed piece by piece (also of many gzip members)."""

    def __init__(self, data: bytes):
        self.data, self.at, self.buffer = data, 0, bytearray()
        self.packed = data[:2] == b"\x1f\x8b"
        self.unpack = zlib.decompressobj(31) if self.packed else None

    def more(self) -> bool:
        piece = self.data[self.at : self.at + (1 << 18)]
        if not piece:
            return False
        self.at += len(piece)
        while piece and self.packed:
            self.buffer += self.unpack.decompress(piece)
            piece = self.unpack.unused_data
            if self.unpack.eof:
                self.unpack = zlib.decompressobj(31)
        self.buffer += piece
        return True

    def until(self, mark: bytes) -> bytes | None:
        start = 0
        while (i := self.buffer.find(mark, start)) < 0:
            start = max(0, len(self.buffer) - len(mark) + 1)
            if not self.more():
                return None
        out = bytes(self.buffer[:i])
        del self.buffer[: i + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n and self.more():
            pass
        if len(self.buffer) < n:
            raise ValueError("archive ends within a record")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in lower case) and block of each record of an archive."""
    source = _Source(data)
    while (head := source.until(b"\r\n\r\n")) is not None:
        lines = head.decode().split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record: {lines[0][:80]}")
        headers = {k.lower(): v for k, _, v in (x.partition(": ") for x in lines[1:])}
        block = source.take(int(headers["content-length"]))
        source.take(4)
        yield headers, block


RECORDS = (
    "record_type string, record_id string, concurrent_to string, refers_to string, uri string, "
    "digest string, payload_digest string, payload_bytes long, payload binary, fields map<string,string>"
)


def _reader(with_payload: bool):
    names = [c.split()[0] for c in RECORDS.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["content"]:
                out, held = [], 0
                for head, block in parse(data):
                    kind, payload, fields = head["warc-type"], None, {}
                    if kind in ("response", "revisit"):
                        payload = block.partition(b"\r\n\r\n")[2]
                    elif kind == "metadata":
                        fields = dict(x.split(": ", 1) for x in block.decode().split(CRLF) if x)
                    real = base64.b32encode(hashlib.sha1(payload).digest()).decode() if kind == "response" else None
                    out.append(
                        (
                            kind, head["warc-record-id"], head.get("warc-concurrent-to"), head.get("warc-refers-to"),
                            head.get("warc-target-uri"), head.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                            real, len(payload) if kind == "response" else None,
                            payload if with_payload and kind == "response" else None, fields,
                        )
                    )
                    held += len(block) + 500
                    if held > 8 << 20:
                        yield _frame(out, names)
                        out, held = [], 0
                yield _frame(out, names)

    return read


def _frame(out: list[tuple], names: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(out, columns=names)
    frame["payload_bytes"] = frame["payload_bytes"].astype("Int64")
    return frame


def read_records(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """All records of the archives under ``path``; digest and length are those of the bytes read."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(_reader(with_payload), RECORDS)


def assemble(rows: DataFrame) -> DataFrame:
    """One nested row per capture: its main, request and metadata record.

    Every record names the main record, in its own id or as concurrent to it, so one shuffle on
    that id joins all three. A capture without a main record keeps null there.
    """
    main = F.col("record_type").isin("response", "revisit")
    of = lambda kind: F.first(F.when(kind, F.struct(*[c for c in rows.columns])), ignorenulls=True)
    return (
        rows.withColumn("capture", F.when(main, F.col("record_id")).otherwise(F.col("concurrent_to")))
        .groupBy("capture")
        .agg(
            of(main).alias("main"),
            of(F.col("record_type") == "request").alias("request"),
            of(F.col("record_type") == "metadata").alias("metadata"),
        )
    )


def page_of(record_id: Column) -> Column:
    """Page id within a record id of ``captures``; null where the page had none."""
    return F.split_part(record_id, F.lit(":"), F.lit(3)).try_cast("long")
