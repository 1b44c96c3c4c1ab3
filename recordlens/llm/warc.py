"""WARC archives of pages: written and read as Zstandard files, one frame per record.

An archive begins with a skippable frame that holds the dictionary of all its other
frames, itself compressed. Every record is a frame of its own. Spark's text writer puts
the frames into files: the line separator is an empty skippable frame, which readers of
Zstandard pass over. So archives go wherever Spark can write, and a lost task leaves no
half-written file.

The reader takes the files from Spark too, walks the blocks of each frame to its end,
decodes one record at a time and checks headers, lengths and digests.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlens.functions.names import named
from recordlens.operators.spread import lookup
from recordlens.storage import Workspace

# Payload bytes of an archive, of the sample its dictionary is trained on, and of the
# dictionary; frame bytes that a task hands over at a time.
ARCHIVE_BYTES = 16 << 20
SAMPLE_BYTES = 1 << 20
DICTIONARY_BYTES = 64 << 10
BATCH_BYTES = 4 << 20
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"

# Fixed values of the formats.
FRAME = 0xFD2FB528
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
SEPARATOR = "P*M\x18\0\0\0\0"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
VERSIONS = (b"WARC/1.0", b"WARC/1.1")
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")

RECORD = (
    "path string, offset long, record_id string, record_type string, target_uri string, date string,"
    " payload_bytes long, payload_digest string, refers_to string, problem string"
)


class Damaged(ValueError):
    """What is wrong with a frame or a record."""


def _header(text: str | None) -> str | None:
    """A header's value; what would end the line is percent-encoded."""
    return text and re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", text)


def record(
    record_id: str,
    payload: bytes,
    digest: bytes,
    n_bytes: int,
    *,
    uri: str | None = None,
    refers_to: str | None = None,
    date: str = DATE,
) -> bytes:
    """A response, or with ``refers_to`` a revisit, whose payload is left out (empty)."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {n_bytes}\r\n\r\n"
    block = head.encode() + payload
    fields = {
        "WARC-Type": "revisit" if refers_to else "response",
        "WARC-Record-ID": f"<{record_id}>",
        "WARC-Date": date,
        "WARC-Target-URI": _header(uri),
        "WARC-Profile": REVISIT_PROFILE if refers_to else None,
        "WARC-Refers-To": f"<{refers_to}>" if refers_to else None,
        "WARC-Payload-Digest": f"sha1:{base64.b32encode(digest).decode()}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    lines = "".join(f"{name}: {value}\r\n" for name, value in fields.items() if value)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n"


def dictionary_frame(sample: list[bytes]) -> tuple[bytes, zstandard.ZstdCompressionDict | None]:
    """The leading frame and its dictionary; too small a sample gives neither."""
    try:
        made = zstandard.train_dictionary(DICTIONARY_BYTES, sample)
    except (zstandard.ZstdError, ValueError):
        return b"", None
    body = zstandard.ZstdCompressor(level=LEVEL).compress(made.as_bytes())
    return DICTIONARY_FRAME.to_bytes(4, "little") + len(body).to_bytes(4, "little") + body, made


def archive(records: Iterable[bytes]) -> Iterator[bytes]:
    """The frames of an archive: the dictionary's, then one for each record.

    The dictionary comes from the records up to SAMPLE_BYTES that come first; it bears on
    the size of the archive alone.
    """
    records = iter(records)
    sample, held = [], 0
    for one in records:
        sample.append(one)
        held += len(one)
        if held >= SAMPLE_BYTES:
            break
    leading, made = dictionary_frame(sample)
    if leading:
        yield leading
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=made, write_checksum=True)
    for one in sample:
        yield packer.compress(one)
    for one in records:
        yield packer.compress(one)


def write_archives(
    pages: DataFrame,
    folder: str,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    body_col: str = "html",
    min_bytes: int = 0,
    archive_bytes: int = ARCHIVE_BYTES,
) -> None:
    """Write one record per page into archives below ``folder``.

    The payload is the body in UTF-8; a null body is empty. Among pages with equal payloads
    of at least ``min_bytes`` the one with the largest id is a response and the others
    revisit it; smaller payloads are all responses. Rows that share the largest id are all
    responses; a page without id revisits like any other, and if no page of a payload has an
    id, all are responses. Payloads are equal if their SHA-1 and length are. A page's record
    is urn:page:<id>; one without id gets a urn:uuid of its payload. A null url gives no
    target; white space and control characters in a url are percent-encoded. Other columns
    are ignored, whatever their names. An empty table gives archives without records.
    """
    work = Workspace(pages.sparkSession, "warc")
    body = F.coalesce(named(body_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        named(id_col).cast("long").alias("id"),
        named(url_col).cast("string").alias("url"),
        body.alias("payload"),
    ).withColumns({"digest": F.unhex(F.sha1("payload")), "n_bytes": F.octet_length("payload")})
    total = rows.agg(F.coalesce(F.sum(F.col("n_bytes").cast("long")), F.lit(0))).first()[0]
    keys = {"digest": "its_digest", "n_bytes": "its_bytes"}
    firsts = work.keep(
        rows.filter(F.col("n_bytes") >= min_bytes)
        .groupBy(*(F.col(c).alias(its) for c, its in keys.items()))
        .agg(F.max("id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1 AND first_id IS NOT NULL"),
        "firsts",
    )
    n_archives = max(1, -(-total // archive_bytes))
    # What revisits another page carries no payload any further.
    revisits = F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    dealt = (
        lookup(rows, firsts, keys, weight="copies", how="left")
        .withColumn("refers_to", F.when(revisits, F.col("first_id")))
        .withColumn("payload", F.when(F.col("refers_to").isNull(), F.col("payload")).otherwise(F.lit(b"")))
        .drop("first_id")
        .repartition(n_archives)
    )

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                for start in range(0, batch.num_rows, 64):
                    for row in batch.slice(start, 64).to_pylist():
                        own = row["id"]
                        if own is None:
                            name = f"urn:uuid:{row['digest'].hex()[:32]}"
                        else:
                            name = f"urn:page:{own}"
                        first = row["refers_to"]
                        yield record(
                            name,
                            row["payload"],
                            row["digest"],
                            row["n_bytes"],
                            uri=row["url"],
                            refers_to=None if first is None else f"urn:page:{first}",
                        )

        held, size = [], 0
        for frame in archive(records()):
            held.append(frame)
            size += len(frame)
            if size >= BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["frame"])
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.binary())], names=["frame"])

    # As text in name only: Spark writes the bytes as they are.
    dealt.mapInArrow(frames, "frame binary").select(
        F.col("frame").cast("string").alias("value")
    ).write.option("lineSep", SEPARATOR).option("compression", "none").text(folder)
    work.forget("firsts")


@dataclass
class Frames:
    """The frames of an archive, each found by walking its blocks."""

    data: memoryview

    def _number(self, at: int, size: int) -> int:
        if at + size > len(self.data):
            raise Damaged("frame cut short")
        return int.from_bytes(self.data[at : at + size], "little")

    def _end(self, start: int) -> int:
        """Where the frame of compressed data at ``start`` ends."""
        flags = self._number(start + 4, 1)
        alone, checked = flags >> 5 & 1, flags >> 2 & 1
        size_bytes = (alone, 2, 4, 8)[flags >> 6]
        at = start + 5 + (not alone) + (0, 1, 2, 4)[flags & 3] + size_bytes
        last = False
        while not last:
            block = self._number(at, 3)
            last, kind, size = bool(block & 1), block >> 1 & 3, block >> 3
            if kind == 3:
                raise Damaged("reserved block type")
            at += 3 + (1 if kind == 1 else size)
        at += 4 * checked
        if at > len(self.data):
            raise Damaged("frame cut short")
        return at

    def dictionary(self) -> zstandard.ZstdCompressionDict | None:
        """The dictionary in the leading skippable frame, plain or compressed, if there is one."""
        if len(self.data) < 8 or self._number(0, 4) != DICTIONARY_FRAME:
            return None
        size = self._number(4, 4)
        body = bytes(self.data[8 : 8 + size])
        if len(body) < size:
            raise Damaged("dictionary cut short")
        if int.from_bytes(body[:4], "little") == FRAME:
            body = zstandard.ZstdDecompressor().decompressobj().decompress(body)
        return zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_FULLDICT)

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """Start and end of each frame of compressed data."""
        at = 0
        while at < len(self.data):
            magic = self._number(at, 4)
            if magic in SKIPPABLE:
                at += 8 + self._number(at + 4, 4)
                if at > len(self.data):
                    raise Damaged("frame cut short")
            elif magic == FRAME:
                end = self._end(at)
                yield at, end
                at = end
            else:
                raise Damaged("not a frame")


def parse(data: bytes) -> dict:
    """The fields of one record, checked; raises Damaged, with the fields read so far."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.split(b"\r\n")
    if not gap or version not in VERSIONS:
        raise Damaged("no WARC header")
    fields: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon or not name or name != name.strip():
            raise Damaged("malformed header line")
        fields.setdefault(name.lower(), value.strip())
    for name in REQUIRED:
        if name not in fields:
            raise Damaged(f"no {name}")
    size = fields["content-length"]
    if not re.fullmatch("[0-9]+", size) or len(rest) != int(size) + 4 or rest[-4:] != b"\r\n\r\n":
        raise Damaged("content-length is not the block's")
    bare = lambda name: (fields.get(name) or "").strip("<>") or None
    scheme, _, digest = (fields.get("warc-payload-digest") or "").partition(":")
    found = {
        "record_id": bare("warc-record-id"),
        "record_type": fields["warc-type"].lower(),
        "target_uri": fields.get("warc-target-uri"),
        "date": fields["warc-date"],
        "payload_digest": digest or None,
        "refers_to": bare("warc-refers-to"),
    }
    block = rest[:-4]
    if found["record_type"] not in ("response", "revisit"):
        return found | {"payload": block, "payload_bytes": len(block)}
    answer, gap, payload = block.partition(b"\r\n\r\n")
    told = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)[ \t]*\r?$", answer)
    if not answer.startswith(b"HTTP/") or not gap:
        raise Damaged("no HTTP head")
    if found["record_type"] == "revisit":
        if not found["refers_to"] or payload:
            raise Damaged("a revisit without target or with a payload")
        return found | {"payload": None, "payload_bytes": int(told[1]) if told else None}
    if told and int(told[1]) != len(payload):
        raise Damaged("HTTP content-length is not the payload's")
    if scheme.lower() == "sha1" and digest.upper() != base64.b32encode(hashlib.sha1(payload).digest()).decode():
        raise Damaged("payload digest does not match")
    return found | {"payload": payload, "payload_bytes": len(payload)}


def records_of(content: bytes) -> Iterator[dict]:
    """The records of an archive with their offsets; a damaged one has its ``problem`` alone.

    Where a frame's end cannot be found, what follows cannot be read and counts as one.
    """
    frames = Frames(memoryview(content))
    at = 0
    try:
        unpacker = zstandard.ZstdDecompressor(dict_data=frames.dictionary())
        for at, end in frames:
            try:
                # As one frame must be one record, whatever size it declares.
                data = unpacker.decompressobj().decompress(frames.data[at:end])
                yield {"offset": at, "problem": None} | parse(data)
            except (Damaged, zstandard.ZstdError) as wrong:
                yield {"offset": at, "problem": str(wrong)}
            at = end
    except (Damaged, zstandard.ZstdError) as wrong:
        yield {"offset": at, "problem": str(wrong)}


def read_archives(spark: SparkSession, folder: str, *, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives in ``folder``, whatever program wrote them.

    Columns: path, offset, record_id, record_type, target_uri, date, payload_bytes,
    payload_digest (without its scheme), refers_to, problem, and payload if asked for. The
    payload of a revisit is null and its bytes are those that its HTTP head states. A damaged
    record has nulls but for path, offset and problem; an empty file has no records.
    """
    names = [c.split()[0] for c in RECORD.split(",")] + ["payload"] * with_payload
    schema = RECORD + ", payload binary" * with_payload
    kinds = {"offset": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows: list[dict]) -> pa.RecordBatch:
            columns = [pa.array([r.get(n) for r in rows], kinds.get(n, pa.string())) for n in names]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                held, size = [], 0
                for found in records_of(content.as_py()):
                    held.append(found | {"path": path.as_py()})
                    size += 256 + with_payload * (found.get("payload_bytes") or 0)
                    if size >= BATCH_BYTES:
                        yield made(held)
                        held, size = [], 0
                if held:
                    yield made(held)

    files = spark.read.format("binaryFile").load(folder).select("path", "content")
    return files.mapInArrow(records, schema)


def page_number(name: Column) -> Column:
    """The page id in a record's name, null if it has none."""
    return F.regexp_extract(name, "^urn:page:(-?[0-9]+)$", 1).try_cast("long")
