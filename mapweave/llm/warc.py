"""WARC archives: one gzip member per record, and a sequential reader.

Pages are written as response records, or as revisit records where another page
has the same payload. Each Spark task writes archives of its own. The reader
goes through an archive record by record: it inflates one member at a time from
small pieces of the input, reads the header, frames the block by its
content length, and checks the digests of block and payload on the way.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapweave.llm import binary_files

# Copies of the groups' winners, so that the rows of one group go to as many tasks.
SALTS = 32
# Bytes of one archive, to which one record at most is added.
ARCHIVE_BYTES = 64 << 20
# Pages taken at a time.
PAGES = 256
PIECE = 1 << 16
GZIP = 31
LEVEL = 6
# Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http;msgtype=response"
DATE = "1970-01-01T00:00:00Z"
PAGE_URN = "urn:page:"


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(page: str, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One record as gzip members that end in a zero byte."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{PAGE_URN}{page}>"),
        ("WARC-Date", DATE),
        ("WARC-Block-Digest", f"sha1:{digest(block)}"),
        ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
    ]
    if url is not None:
        # A header value is one line.
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if revisit:
        fields += [("WARC-Refers-To", f"<{PAGE_URN}{refers_to}>"), ("WARC-Profile", PROFILE)]
    fields += [("Content-Type", HTTP_TYPE), ("Content-Length", str(len(block)))]
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields).encode("utf-8", "surrogatepass") + b"\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
    out = packer.compress(head) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()
    if not out.endswith(binary_files.END):
        # The last byte is the highest of the length, not zero from 16 MB on; an empty member ends in zeros.
        packer = zlib.compressobj(LEVEL, zlib.DEFLATED, GZIP)
        out += packer.flush()
    return out


class Member:
    """Reads one gzip member from ``data`` at ``start``, inflating as it is asked for bytes."""

    def __init__(self, data: bytes, start: int):
        self._data, self._at = data, start
        self._inflate = zlib.decompressobj(GZIP)
        self._ready = bytearray()

    def _more(self) -> bool:
        if self._inflate.eof:
            return False
        piece = self._inflate.unconsumed_tail
        if not piece:
            piece = self._data[self._at : self._at + PIECE]
            self._at += len(piece)
        out = self._inflate.decompress(piece, PIECE)
        if not piece and not out and not self._inflate.eof:
            raise ValueError("the archive ends inside a record")
        self._ready += out
        return True

    def until(self, mark: bytes) -> bytes:
        """Bytes up to and without ``mark``; all that is left where it does not come."""
        seen = 0
        while (found := self._ready.find(mark, seen)) < 0:
            seen = max(0, len(self._ready) - len(mark) + 1)
            if not self._more():
                found = len(self._ready)
                break
        out = bytes(self._ready[:found])
        del self._ready[: found + len(mark)]
        return out

    def pieces(self, count: int) -> Iterator[bytes]:
        """Exactly ``count`` bytes, piece by piece."""
        while count:
            if not self._ready and not self._more():
                raise ValueError("a record is shorter than its content length")
            piece = bytes(self._ready[:count])
            del self._ready[: len(piece)]
            count -= len(piece)
            if piece:
                yield piece

    def end(self) -> int:
        """Read to the member's end; the offset of the next one."""
        while self._more():
            pass
        return self._at - len(self._inflate.unused_data)


def _headers(block: bytes) -> dict[str, str]:
    lines = block.decode("utf-8", "surrogatepass").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def read_records(data: bytes, keep_payload: bool = False) -> Iterator[dict]:
    """The records of an archive in order; a fault in framing or digests raises ValueError."""
    at = 0
    while at < len(data):
        member = Member(data, at)
        head = member.until(b"\r\n\r\n")
        if not head:
            at = member.end()
            continue
        if not head.startswith(b"WARC/"):
            raise ValueError("no WARC record where one should begin")
        fields = _headers(head)
        length = int(fields["content-length"])
        block_sum, payload_sum = hashlib.sha1(), hashlib.sha1()
        http, inside, kept = bytearray(), False, []
        for piece in member.pieces(length):
            block_sum.update(piece)
            if not inside:
                http += piece
                stop = http.find(b"\r\n\r\n")
                if stop < 0:
                    continue
                inside, piece = True, bytes(http[stop + 4 :])
                del http[stop:]
            payload_sum.update(piece)
            if keep_payload:
                kept.append(piece)
        if member.until(b"\r\n\r\n"):
            raise ValueError("a record is longer than its content length")
        at = member.end()
        sums = {"warc-block-digest": block_sum}
        if fields["warc-type"] == "response":
            sums["warc-payload-digest"] = payload_sum
        for name, value in sums.items():
            if fields[name] != "sha1:" + base64.b32encode(value.digest()).decode():
                raise ValueError(f"{name} of {fields['warc-record-id']} does not fit")
        yield fields | {"payload-length": int(_headers(bytes(http))["content-length"]), "payload": b"".join(kept)}


def with_originals(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    """(page, url, payload, refers_to): pages with the page whose equal payload stands for theirs."""
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).cast("binary")
    own = pages.select(
        F.col(f"`{page_id}`").alias("page"), F.col(f"`{url}`").cast("string").alias("url"), payload.alias("payload")
    ).withColumn("_sum", F.sha1("payload"))
    groups = own.groupBy("_sum").agg(F.max("page").alias("_original"), F.count(F.lit(1)).alias("_copies"))
    salted = groups.where(F.col("_copies") > 1).select(
        F.col("_sum").alias("_of"), "_original", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_slot")
    )
    salt = F.pmod(F.xxhash64("page", "url"), F.lit(SALTS)).cast("int")
    match = (F.col("_sum") == F.col("_of")) & (F.col("_salt") == F.col("_slot"))
    refers = F.when(~F.col("page").eqNullSafe(F.col("_original")), F.col("_original"))
    return own.withColumn("_salt", salt).join(salted, match, "left").select("page", "url", "payload", refers.alias("refers_to"))


def write_archives(
    pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html"
) -> None:
    """Write a WARC record per page into archives under ``path``.

    The payload is the text in UTF-8 (null: empty). Of pages with equal payloads, empty ones
    too, the one with the largest id is the response and the others revisit it.
    Rows with that same id are all responses; null ids come below all others. A null
    url is left out. No pages give no archives. A task begins another archive, in a folder of
    its own, once one has ARCHIVE_BYTES.
    """
    most = ARCHIVE_BYTES

    def run(batches):
        archive = size = 0
        for batch in batches:
            for begin in range(0, batch.num_rows, PAGES):
                columns = [batch.column(i).slice(begin, PAGES).to_pylist() for i in range(4)]
                out, archives = [], []
                for page, address, data, original in zip(*columns, strict=True):
                    if size >= most:
                        archive, size = archive + 1, 0
                    out.append(record_bytes(str(page), address, data, None if original is None else str(original))[:-1])
                    archives.append(archive)
                    size += len(out[-1]) + 1
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(archives, pa.int32())], names=["record", "archive"])

    decided = with_originals(pages, page_id, url, html)
    records = decided.mapInArrow(run, "record binary, archive int")
    binary_files.write_records(records, "record", path, folder="archive")


def read_archives(spark: SparkSession, path: str, keep_payload: bool = False, id_type: str = "long") -> DataFrame:
    """One row per record: page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload.

    Every record is framed and its digests are checked; a fault fails the job.
    ``payload`` is null for revisits and unless it is asked for.
    """
    columns = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]

    def page_of(value: str | None) -> str | None:
        name = value and value.strip("<>").removeprefix(PAGE_URN)
        return None if name == "None" else name

    def run(batches):
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows = []
                try:
                    for r in read_records(content.as_py(), keep_payload):
                        whole = keep_payload and r["warc-type"] == "response"
                        rows.append(
                            (
                                page_of(r["warc-record-id"]),
                                r.get("warc-target-uri"),
                                r["payload-length"],
                                r["warc-payload-digest"].removeprefix("sha1:"),
                                r["warc-type"],
                                page_of(r.get("warc-refers-to")),
                                r["payload"] if whole else None,
                            )
                        )
                except ValueError as fault:
                    raise ValueError(f"{file}: {fault}") from fault
                arrays = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays(arrays, names=columns)

    schema = "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string, payload binary"
    read = binary_files.read_files(spark, path).mapInArrow(run, schema)
    return read.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})
