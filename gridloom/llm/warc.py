"""WARC archives as a chunked record table.

A payload is cut into chunk rows ``(record, chunk number, bytes)``. Each chunk
is one WARC record: the first is the response, later ones are its
continuations, as the format's segmentation fields say. The text sink writes
them, with the two line ends that close a record as its row separator, so an
archive is a plain gzip file of records. Reading splits at that separator and
follows Content-Length through the rows, chunk by chunk, with running digests:
no step holds a payload larger than a chunk in Python.
"""

from __future__ import annotations

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import arrow_rows
from gridloom.session import new_work_folder

CHUNK_BYTES = 1 << 20
END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"  # fixed, so that equal tables give equal archives
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed value

_CHUNKS = pa.schema([
    ("record_id", pa.string()), ("chunk", pa.int64()), ("record_type", pa.string()),
    ("page_id", pa.string()), ("url", pa.binary()), ("refers_to", pa.string()), ("data", pa.binary()),
    ("bytes_so_far", pa.int64()), ("digest_so_far", pa.string()), ("last", pa.bool_()),
    ("stated_bytes", pa.int64()), ("stated_digest", pa.string()),
])
CHUNK_SCHEMA = (
    "record_id string, chunk long, record_type string, page_id string, url binary, refers_to string, "
    "data binary, bytes_so_far long, digest_so_far string, last boolean, stated_bytes long, stated_digest string"
)


def _base32(hex_digest: Column) -> Column:
    """Base 32 of a 20-byte digest given in hex: 20 bits make four characters."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    out = []
    for group in range(8):
        bits = F.conv(F.substring(hex_digest, group * 5 + 1, 5), 16, 10).cast("int")
        out += [F.substring(letters, F.shiftright(bits, s).bitwiseAND(F.lit(31)) + 1, F.lit(1))
                for s in (15, 10, 5, 0)]
    return F.concat(*out)


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def record_table(pages: DataFrame, *, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Chunk rows of every page with their WARC headers.

    Of equal payloads the row with the largest ``page_id`` is the response and
    others are revisits of it, which have no block. Rows that repeat that
    ``page_id`` as well are responses too. A null ``page_id`` is smaller than
    any other; if a payload has none but null ids, all its rows are responses.
    """
    content = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    base = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        content.alias("payload"), F.sha2(content, 256).alias("sha"),
    )
    firsts = (
        base.groupBy("sha").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
        .where("n > 1").select("sha", "keeper")
    )
    known = base.join(firsts, "sha", "left").withColumn(
        "revisit", F.coalesce(~F.col("page_id").eqNullSafe(F.col("keeper")) & F.col("keeper").isNotNull(),
                              F.lit(False))
    )
    length = F.octet_length("payload").cast("long")
    pieces = F.when(F.col("revisit"), F.lit(1).cast("long")).otherwise(
        F.greatest(F.lit(1).cast("long"), F.ceil(length / F.lit(chunk_bytes)).cast("long"))
    )
    rows = known.select(
        "page_id", "url", "revisit", "keeper", "payload", length.alias("length"), pieces.alias("pieces"),
        _base32(F.sha1("payload")).alias("digest"),
        F.format_string("<urn:x-page:%s>", F.coalesce(F.col("page_id").cast("string"), F.lit("none"))).alias("record_id"),
    ).withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)))
    size = F.lit(chunk_bytes)
    block = F.when(F.col("revisit"), F.lit(b"")).otherwise(
        F.substring(F.col("payload"), (F.col("chunk") * size + 1).cast("int"), size)
    )
    rows = rows.withColumn("block", block).drop("payload")
    first, cut = F.col("chunk") == 0, F.col("pieces") > 1
    kind = F.when(~first, F.lit("continuation")).when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response"))
    own = F.when(first, F.col("record_id")).otherwise(
        F.format_string("%s/%d>", F.expr("substring(record_id, 1, length(record_id) - 1)"), F.col("chunk")))
    at_start = lambda c: F.when(first, c)
    uri = F.regexp_replace("url", r"[\r\n]+", "")
    header = F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", kind), _line("WARC-Record-ID", own),
        _line("WARC-Date", F.lit(DATE)), _line("WARC-Target-URI", at_start(uri)),
        _line("WARC-Payload-Digest", at_start(F.concat(F.lit("sha1:"), "digest"))),
        _line("X-Payload-Length", at_start(F.col("length").cast("string"))),
        _line("WARC-Profile", F.when(F.col("revisit"), F.lit(REVISIT_PROFILE))),
        _line("WARC-Refers-To", F.when(F.col("revisit"), F.format_string("<urn:x-page:%s>", "keeper"))),
        _line("WARC-Segment-Number", F.when(cut, (F.col("chunk") + 1).cast("string"))),
        _line("WARC-Segment-Origin-ID", F.when(~first, F.col("record_id"))),
        _line("WARC-Segment-Total-Length", F.when(F.col("chunk") + 1 == F.col("pieces"),
                                                   F.when(cut, F.col("length").cast("string")))),
        _line("Content-Type", F.lit("text/html")),
        _line("Content-Length", F.octet_length("block").cast("string")), F.lit("\r\n"),
    )
    return rows.select("record_id", "chunk", header.alias("header"), "block")


def write_archives(pages: DataFrame, folder: str, *, chunk_bytes: int = CHUNK_BYTES) -> None:
    """Write gzip archives, one per task, of the ``page_id``, ``url`` and ``html`` columns.

    Null html is an empty payload; other columns are ignored; an empty table
    writes no record. Line ends inside a URL are left out of the header.
    """
    rows = record_table(pages, chunk_bytes=chunk_bytes)
    record = F.concat(F.col("header").cast("binary"), F.col("block")).cast("string")
    rows.select(record.alias("value")).write.option("lineSep", END).option("compression", "gzip").text(folder)


class _Reader:
    """Follows one archive through its pieces; gives the chunks that are complete."""

    def __init__(self):
        self.head, self.left, self.parts = b"", None, []
        self.fields, self.origin = {}, None

    def feed(self, piece: bytes):
        """``piece``: what stood before the next separator, which is taken as read."""
        piece = piece + END.encode()
        while piece:
            if self.left is None:  # in a header
                self.head += piece
                end = self.head.find(END.encode())
                if end < 0:
                    return
                text, piece = self.head[:end].lstrip(b"\r\n"), self.head[end + 4:]
                self.head = b""
                if not text:
                    continue
                lines = text.split(b"\r\n")
                if not lines[0].startswith(b"WARC/"):
                    raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
                self.fields = {k.decode("ascii").strip().lower(): v.strip()
                               for k, _, v in (line.partition(b":") for line in lines[1:])}
                self.left, self.parts = int(self.fields["content-length"]), []
            take, piece = piece[:self.left], piece[self.left:]
            self.parts.append(take)
            self.left -= len(take)
            if not self.left:
                self.left = None
                yield self._chunk(b"".join(self.parts))

    def _chunk(self, data: bytes) -> tuple:
        fields = self.fields
        text = lambda name: fields[name].decode("ascii") if name in fields else None
        kind = text("warc-type")
        if kind == "continuation":
            if not self.origin or self.origin["id"] != text("warc-segment-origin-id"):
                raise ValueError("a continuation does not follow its record")
        else:
            length, digest = text("x-payload-length"), text("warc-payload-digest")
            self.origin = {"id": text("warc-record-id"), "kind": kind, "url": fields.get("warc-target-uri"),
                           "refers": text("warc-refers-to"), "sum": hashlib.sha1(), "bytes": 0, "chunk": -1,
                           "length": int(length) if length else None,
                           "digest": digest.removeprefix("sha1:") if digest else None}
        o = self.origin
        o["sum"].update(data)
        o["bytes"] += len(data)
        o["chunk"] += 1
        last = "warc-segment-number" not in fields or "warc-segment-total-length" in fields
        sofar = base64.b32encode(o["sum"].digest()).decode()
        if last and kind != "revisit" and (sofar, o["bytes"]) != (o["digest"], o["length"]):
            raise ValueError(f"{o['id']}: the payload does not match its digest")
        page = lambda urn: urn and (None if urn == "<urn:x-page:none>" else urn[12:-1])
        return (o["id"], o["chunk"], o["kind"], page(o["id"]), o["url"], page(o["refers"]), data,
                o["bytes"], sofar, last, o["length"], o["digest"])


def _read(batches):
    reader, file = _Reader(), None
    for batch in batches:
        rows = {name: [] for name in _CHUNKS.names}
        held = 0
        for name, piece in zip(*(c.to_pylist() for c in batch.columns)):
            if name != file:  # archives are read whole, one after the other
                reader, file = _Reader(), name
            for chunk in reader.feed(piece):
                for column, value in zip(_CHUNKS.names, chunk):
                    rows[column].append(value)
                held += len(chunk[6])
                if held > 8 << 20:
                    yield arrow_rows(_CHUNKS, rows)
                    rows, held = {name: [] for name in _CHUNKS.names}, 0
        yield arrow_rows(_CHUNKS, rows)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Chunk rows of the archives in a folder, in order inside each archive.

    ``digest_so_far`` and ``bytes_so_far`` cover the payload up to the chunk;
    the ``last`` row of a record holds those of the whole payload. A payload
    that does not match what its header states raises. For revisits, which
    have no payload, the stated values are those of the payload they refer to.
    """
    pieces = spark.read.option("lineSep", END).text(folder).select(
        F.input_file_name().alias("file"), F.col("value").cast("binary").alias("piece"))
    return pieces.mapInArrow(_read, CHUNK_SCHEMA)


def archived_pages(pages: DataFrame, *, folder: str | None = None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Write the pages, read the archives back, and report each record.

    Result per page: ``page_id``, ``payload_bytes``, ``payload_digest``,
    ``record_type``, ``refers_to``; for responses both payload columns are
    computed from the bytes read.
    """
    spark = pages.sparkSession
    folder = folder or new_work_folder(spark, "archives")
    write_archives(pages, folder, chunk_bytes=chunk_bytes)
    revisit = F.col("record_type") == "revisit"
    return read_archives(spark, folder).where("last").select(
        F.col("page_id").cast("long").alias("page_id"),
        F.when(revisit, F.col("stated_bytes")).otherwise(F.col("bytes_so_far")).alias("payload_bytes"),
        F.when(revisit, F.col("stated_digest")).otherwise(F.col("digest_so_far")).alias("payload_digest"),
        "record_type", F.col("refers_to").cast("long").alias("refers_to"),
    )
