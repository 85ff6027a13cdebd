"""WARC archives: writing captures as request, response or revisit, and metadata records, and putting them together again.

Writing is a text table of records: a record ends with two line ends, which is the line separator of the writer, so every
part file is a gzip-compressed WARC file that Spark commits, retries and stores like any other output. Only pages with a payload
of ``REVISIT_BYTES`` or more are compared: of equal payloads the one with the largest id is stored, the others refer to it.
What is compared are digests and ids; the payloads themselves are shuffled once, evenly, by id.

Reading parses whole archive files inside tasks, by the lengths in their headers. The assembly joins requests and metadata to
responses and revisits through WARC-Concurrent-To and returns one nested row per capture.

Defined cases: a null payload is an empty one; a null url is an empty target; equal payloads under equal ids are each stored
as a response; repeated rows give as many captures; an id may be null, then it is empty in the archive and null when read;
an empty table gives no archive and no capture.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lossmetrics.llm.tables import folder

REVISIT_BYTES = 1_000
_END = "\r\n"
_RECORD_END = "\r\n\r\n"
#: Rows per archive file at most, and payload bytes per file on average; a file is read by one task.
FILE_ROWS = 20_000
FILE_BYTES = 64 << 20
_RECORDS = (
    "record_id string, kind string, concurrent_to string, refers_to string, target string, digest string, length long, "
    "page_id string, payload_bytes long, payload binary"
)
#: Text of records handed to Spark at once, and of an archive inflated at once.
_BATCH_BYTES = 4 << 20
_PIECE = 1 << 20


def revisits(pages: DataFrame, key: str = "page_id", payload: str = "html") -> DataFrame:
    """(``key``, ``refers_to``) for pages whose payload is that of a page with a larger id."""
    light = pages.select(F.col(key), F.sha1(F.coalesce(payload, F.lit(""))).alias("digest"), F.octet_length(payload).alias("bytes"))
    light = light.where(F.col("bytes") >= REVISIT_BYTES).where(F.col(key).isNotNull())
    heads = light.groupBy("digest", "bytes").agg(F.max(key).alias("refers_to"), F.min(key).alias("least")).where("least < refers_to")
    pairs = light.join(heads, ["digest", "bytes"]).where(F.col(key) < F.col("refers_to"))
    return pairs.select(key, "digest", "refers_to").distinct()


def _named(kind: str, *parts: Column) -> Column:
    """A record id hashed from what identifies the record."""
    digest = F.md5(F.concat_ws("|", F.lit(kind), *parts))
    groups = [F.substring(digest, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *groups), F.lit(">"))


def _record(kind: str, ident: Column, url: Column, block: Column, *more: tuple[str, Column]) -> Column:
    """A record without its end; a header whose value is null is left out."""
    fields = [("WARC-Type", F.lit(kind)), ("WARC-Record-ID", ident), ("WARC-Date", F.lit("1970-01-01T00:00:00Z")), ("WARC-Target-URI", url), *more]
    lines = [F.concat(F.lit(f"{name}: "), value) for name, value in fields]
    size = F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))
    return F.concat(F.concat_ws(_END, F.lit("WARC/1.1"), *lines, size), F.lit(_RECORD_END), block)


def write(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> str:
    """Write three records per row into a new folder of archives and return its path. WARC-Date is fixed: nothing reads the clock.

    A file is closed after as many rows as hold ``FILE_BYTES`` at the table's mean payload, ``FILE_ROWS`` at most.
    """
    mean = pages.agg(F.avg(F.coalesce(F.octet_length(payload), F.lit(0)))).first()[0] or 0.0
    file_rows = int(max(1, min(FILE_ROWS, FILE_BYTES // max(mean, 1))))
    sha = F.sha1(F.coalesce(payload, F.lit("")))
    rows = pages.select(
        F.col(key).alias("key"), F.coalesce(url, F.lit("")).alias("url"), F.coalesce(payload, F.lit("")).alias("body"), sha.alias("digest")
    )
    pairs = revisits(pages, key, payload).select(F.col(key).alias("key"), "digest", "refers_to")
    rows = rows.join(pairs, ["key", "digest"], "left")
    # Rows that agree in everything are told apart by a number.
    same = Window.partitionBy("key", "digest").orderBy("url")
    rows = rows.withColumn("nth", F.row_number().over(same).cast("string"))
    ident = F.coalesce(F.col("key").cast("string"), F.lit(""))
    of = lambda kind: _named(kind, ident, F.col("url"), F.col("digest"), F.col("nth"))
    # A line end inside an url would end its header; percent-encode the two characters.
    target = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    ask = F.concat(F.lit("GET "), target, F.lit(" HTTP/1.1" + _RECORD_END))
    again = F.col("refers_to").isNotNull()
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    response = F.when(
        again,
        _record(
            "revisit", of("response"), target, F.lit(""), ("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            ("WARC-Payload-Digest", digest), ("X-Refers-To-Page", F.col("refers_to").cast("string")),
        ),
    ).otherwise(_record("response", of("response"), target, F.col("body"), ("WARC-Payload-Digest", digest)))
    facts = F.concat_ws(_END, F.concat(F.lit("page-id: "), ident), F.concat(F.lit("payload-bytes: "), F.octet_length("body").cast("string")))
    beside = ("WARC-Concurrent-To", of("response"))
    records = F.array(_record("request", of("request"), target, ask, beside), response, _record("metadata", of("metadata"), target, facts, beside))
    path = folder(pages, "warc")
    lines = rows.select(F.explode(records).alias("value"))
    lines.write.option("compression", "gzip").option("lineSep", _RECORD_END).option("maxRecordsPerFile", 3 * file_rows).text(path)
    return path


def _inflate(content: bytes) -> Iterator[bytes]:
    """Content of a gzip file with one member or several, a bounded piece at a time."""
    while content:
        member = zlib.decompressobj(31)
        while content and not member.eof:
            yield member.decompress(content, _PIECE)
            content = member.unconsumed_tail if not member.eof else member.unused_data
        if not member.eof:
            raise ValueError("the archive ends inside a compressed member")


def parse(pieces: Iterable[bytes]) -> Iterator[dict]:
    """The records of an archive, found by their headers' lengths; holds one record and one piece at a time."""
    source, held, at = iter(pieces), bytearray(), 0

    def more() -> bool:
        """Forget what has been read and take in another piece; false at the end."""
        nonlocal at
        piece = next(source, None)
        if piece is None:
            return False
        del held[:at]
        at = 0
        held.extend(piece)
        return True

    while at < len(held) or more():
        if at == len(held):
            continue
        searched = 0
        while (end := held.find(b"\r\n\r\n", at + searched)) < 0:
            searched = max(0, len(held) - at - 3)
            if not more():
                raise ValueError("the archive ends inside a header")
        head = dict(line.split(": ", 1) for line in held[at:end].decode("utf-8").split("\r\n")[1:])
        length = int(head["Content-Length"])
        start = end + 4 - at
        while len(held) - at < start + length + 4:
            if not more():
                raise ValueError("the archive ends inside a record")
        block = bytes(held[at + start : at + start + length])
        at += start + length + 4
        kind = head["WARC-Type"]
        record = {
            "record_id": head["WARC-Record-ID"], "kind": kind, "concurrent_to": head.get("WARC-Concurrent-To"),
            "refers_to": head.get("X-Refers-To-Page"), "target": head["WARC-Target-URI"],
            "digest": head.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None, "length": length,
            "page_id": None, "payload_bytes": None, "payload": block if kind == "response" else None,
        }
        if kind == "response" and hashlib.sha1(block).hexdigest() != record["digest"]:
            raise ValueError(f"the payload of {record['record_id']} does not have its digest")
        if kind == "metadata":
            facts = dict(line.split(": ", 1) for line in block.decode("utf-8").split("\r\n"))
            record |= {"page_id": facts["page-id"] or None, "payload_bytes": int(facts["payload-bytes"])}
        yield record


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """All records of the archives below ``path``; ``payloads`` says whether the bodies come along."""
    kinds = spark.createDataFrame([], _RECORDS).schema
    arrow = pa.schema([
        *((n, pa.string()) for n in ("record_id", "kind", "concurrent_to", "refers_to", "target", "digest")),
        ("length", pa.int64()), ("page_id", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()),
    ])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                held, size = [], 0
                for record in parse(_inflate(content.as_py())):
                    if not payloads:
                        record["payload"] = None
                    held.append(record)
                    size += 500 + (record["length"] if payloads else 0)
                    if size > _BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(held, arrow)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, arrow)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(run, kinds)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``response`` (a response or a revisit) with its ``request`` and its ``metadata``."""
    pick = lambda name, *kinds: records.where(F.col("kind").isin(*kinds)).select(
        F.col("record_id" if name == "response" else "concurrent_to").alias("capture_id"), F.struct(*[c for c in records.columns]).alias(name)
    )
    whole = pick("response", "response", "revisit")
    return whole.join(pick("request", "request"), "capture_id", "left").join(pick("metadata", "metadata"), "capture_id", "left")
