"""WARC archives: writing with payload deduplication, and a normaliser for whole-file gzip streams.

``write`` makes one archive per task, compressed as a single gzip stream, as many writers do. Such a file can only be
read from its start. ``normalise`` inflates each file once, as a stream, writes every record again as a gzip member of its
own, and returns a table with a row per record: ``file``, ``offset``, ``length``, ``record_id``, ``record_type``. Records can
then be read by themselves, in any order; ``read`` does so and checks each payload against its digest.

Payloads are compared by SHA-1. Of equal payloads of at least ``min_bytes`` bytes the page with the smallest
page_id is a response (all rows of that page_id with that payload, if repeated) and the others are revisits, records without a block that
name it; their payload length is kept in the field WARC-Payload-Length. A NULL html is an empty payload; rows without
page_id are written as responses and take no part in the comparison. Urls are percent-encoded where a header needs it.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize
from . import files

INDEX = "file string, offset long, length long, record_id string, record_type string"
_READ = 1 << 18
_LEVEL = 6
# Fixed values of the format.
_REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2000-01-01T00:00:00Z"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_types(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """``(page_id, url, html, refers_to)``: refers_to is set for revisits.

    Only ids and digests are grouped; the html moves once, to meet the decision of its page.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    sha1 = F.sha1(F.col("html").cast("binary"))
    hashed = rows.filter(F.col("page_id").isNotNull() & (F.octet_length("html") >= min_bytes)).select("page_id", sha1.alias("sha1"))
    first = hashed.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    # Rows of one page_id may differ in their payloads: each is decided by its own.
    revisits = hashed.join(first, "sha1").filter("page_id <> first").groupBy("page_id", "sha1").agg(F.min("first").alias("refers_to"))
    return rows.withColumn("sha1", sha1).join(revisits, ["page_id", "sha1"], "left").select(*rows.columns, "refers_to")


def _record(page_id, url, payload: bytes, refers_to) -> bytes:
    revisit = refers_to is not None
    block = b"" if revisit else payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", _DATE),
        ("WARC-Target-URI", quote(url or "", safe="!#$%&'()*+,/:;=?@[]~")),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
        ("WARC-Payload-Length", len(payload)),
    ]
    if revisit:
        fields += [("WARC-Profile", _REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    fields += [("Content-Type", "text/html;charset=utf-8"), ("Content-Length", len(block))]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def write(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write a record per page into archives of one gzip stream each; returns the table of their ``file`` names."""
    folder = files.new_folder(pages.sparkSession, "warc-whole")

    def save(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = uri = pack = None
        for batch in batches:
            for page_id, url, html, refers_to in batch.astype(object).where(batch.notna(), None).itertuples(index=False):
                if out is None:
                    uri, out = files.create(folder, ".warc.gz")
                    pack = zlib.compressobj(_LEVEL, wbits=31)
                number = None if page_id is None else int(page_id)
                out.write(pack.compress(_record(number, url, html.encode(), None if refers_to is None else int(refers_to))))
        if out is not None:
            out.write(pack.flush())
            out.close()
            yield pd.DataFrame({"file": [uri]})

    # Ids go as text: a column with NULLs would become floating-point.
    rows = with_types(pages, min_bytes).select(F.col("page_id").cast("string"), "url", "html", F.col("refers_to").cast("string"))
    return materialize(rows.mapInPandas(save, "file string"), "warc-files")


class _Inflated:
    """A whole-file gzip stream, inflated piece by piece; also takes files of several members."""

    def __init__(self, stream):
        self.stream, self.data, self.unpack = stream, bytearray(), None
        self.rest = b""

    def more(self) -> bool:
        packed = self.rest or self.stream.read(_READ)
        if self.unpack is None or self.unpack.eof:
            if not packed:
                return False
            self.unpack = zlib.decompressobj(wbits=31)
        out = self.unpack.decompress(packed, _READ * 4)
        self.rest = self.unpack.unused_data if self.unpack.eof else self.unpack.unconsumed_tail
        if not packed and not out and not self.unpack.eof:
            raise ValueError("the archive ends within a gzip stream")
        self.data += out
        return True

    def until(self, mark: bytes) -> bytes | None:
        seen = 0
        while (at := self.data.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(self.data)
            if not self.more():
                if self.data.strip():
                    raise ValueError("the archive ends within a record")
                return None
        return self.take(at + len(mark))

    def take(self, size: int) -> bytes:
        while len(self.data) < size:
            if not self.more():
                raise ValueError("the archive ends within a record")
        out = bytes(self.data[:size])
        del self.data[:size]
        return out


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines[1:] if line)}


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and bytes of every record of an archive."""
    source = _Inflated(stream)
    while (head := source.until(b"\r\n\r\n")) is not None:
        fields = _fields(head.lstrip())
        yield fields, head.lstrip() + source.take(int(fields["content-length"]) + 4)


def normalise(archives: DataFrame) -> DataFrame:
    """Rewrite each archive of the column ``file`` with one gzip member per record; returns the offset index, stored as a table."""
    folder = files.new_folder(archives.sparkSession, "warc-members")

    def rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in batch["file"]:
                uri, out = files.create(folder, ".warc.gz")
                rows, offset = [], 0
                with files.open_input(name) as stream, out:
                    for fields, record in records(stream):
                        pack = zlib.compressobj(_LEVEL, wbits=31)
                        member = pack.compress(record) + pack.flush()
                        out.write(member)
                        rows.append((uri, offset, len(member), fields.get("warc-record-id"), fields.get("warc-type")))
                        offset += len(member)
                        if len(rows) == 10_000:
                            yield pd.DataFrame(rows, columns=["file", "offset", "length", "record_id", "record_type"])
                            rows = []
                yield pd.DataFrame(rows, columns=["file", "offset", "length", "record_id", "record_type"])

    # An archive is one unit of work, so each gets a task of its own.
    count = max(1, archives.count())
    spread = archives.repartition(count, "file")
    return materialize(spread.mapInPandas(rewrite, INDEX), "warc-index")


def read(index: DataFrame, with_payload: bool = True) -> DataFrame:
    """``(page_id, url, record_type, payload_digest, payload_bytes, refers_to, payload)`` of the records an index names."""

    def load(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to", "payload"]
        for batch in batches:
            rows, size = [], 0
            for member in files.read_spans(zip(batch["file"], batch["offset"], batch["length"])):
                head, _, rest = zlib.decompress(member, wbits=31).partition(b"\r\n\r\n")
                fields = _fields(head)
                block = rest[: int(fields["content-length"])]
                revisit = fields["warc-type"] == "revisit"
                stated = fields["warc-payload-digest"].removeprefix("sha1:")
                length = int(fields["warc-payload-length"])
                if not revisit and (digest(block) != stated or len(block) != length):
                    raise ValueError(f"the payload of {fields['warc-record-id']} is damaged")
                numbers = [fields.get(k, "")[10:-1] or None for k in ("warc-record-id", "warc-refers-to")]
                rows.append((numbers[0], fields["warc-target-uri"], fields["warc-type"], stated, length, numbers[1], block if with_payload else None))
                size += len(block) if with_payload else 0
                if size > _READ * 16:
                    yield pd.DataFrame(rows, columns=names)
                    rows, size = [], 0
            yield pd.DataFrame(rows, columns=names)

    schema = "page_id string, url string, record_type string, payload_digest string, payload_bytes long, refers_to string, payload binary"
    rows = index.select("file", "offset", "length").mapInPandas(load, schema)
    return rows.withColumns({"page_id": F.col("page_id").cast("long"), "refers_to": F.col("refers_to").cast("long")})
