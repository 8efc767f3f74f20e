"""Dictionary-compressed WARC archives: written, and read back, by Spark.

An archive is a leading skippable frame that holds a Zstandard dictionary, then one Zstandard
frame per record, compressed with that dictionary.  The dictionary is built from the first records
of the task that writes the archive; where those are too few or too unlike to train one, it
is their bytes as they are.  Records can be decompressed one by one, and a reader needs nothing but
the file.  A task begins a new archive every ``ARCHIVE_BYTES``.  Spark's text writer puts each into
a file of its own on any Hadoop file system, with its commit protocol, so a lost executor
leaves no half archive; what separates frames is an empty skippable frame, which readers pass over.

Records have the fields that the format requires: an id, a date, the target (a page without url
has a URN of its own) and the length.  The block of a response is an HTTP response whose
payload is the page.  Page ids are in fields of our own, ``X-Page-ID`` and ``X-Refers-To-Page-ID``.
Rows that repeat are archived as often as they occur, each under its own id; a revisit refers to the first.
A table without rows gives archives without records.

Of records with equal payloads (SHA-1) of at least ``REVISIT_BYTES`` bytes, the one with the
largest page id is archived as response, the others as revisits that refer to it.
"""

from __future__ import annotations

import io
import re
import uuid
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from itertools import chain
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from matrixlens.llm.tables import written
from matrixlens.session import shared_folder

REVISIT_BYTES = 1000
#: Bytes of a task's first records that its dictionary is built from, and the size of the dictionary.
SAMPLE_BYTES, DICTIONARY_BYTES = 1 << 20, 1 << 14
#: Compressed bytes from which a task begins another archive: it is one row to Spark, and is read whole.
ARCHIVE_BYTES = 32 << 20
LEVEL = 3
#: Fixed values of the formats: the magic numbers of skippable frames.
DICTIONARY_FRAME, EMPTY_FRAME = 0x184D2A5D, "P*M\x18\x00\x00\x00\x00"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
#: What may stand in a URI as it is; anything else, line ends above all, is escaped.
_URI_SAFE = "!#$%&'()*+,/:;=?@[]~"
_FIELD = re.compile(rb"^([A-Za-z-]+): (.*)\r$", re.M)


def decide_revisits(pages: DataFrame, page_id: str = "page_id", payload: str = "html", url: str = "url") -> DataFrame:
    """``pages`` as page_id, payload, payload_digest, refers_to (null for responses), url, referred_to.

    ``referred_to`` marks the responses that revisits refer to; ``url`` is null where there is no such column.

    Only digests that occur more than once are joined back; they are counted per task before
    anything moves.
    """
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    target = F.col(url) if url in pages.columns else F.lit(None)
    pages = pages.select(F.col(page_id).alias("page_id"), body.alias("payload"), target.cast("string").alias("url"))
    pages = pages.withColumn("payload_digest", F.sha1("payload"))
    known = (
        pages.where(F.octet_length("payload") >= REVISIT_BYTES)
        .groupBy(F.unhex("payload_digest").alias("_key"))
        .agg(F.count(F.lit(1)).alias("_n"), F.max("page_id").alias("_first"))
        .where("_n > 1").select("_key", "_first")
    )
    joined = pages.withColumn("_key", F.unhex("payload_digest")).join(known, "_key", "left")
    older = F.col("_first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("_first")))
    return joined.select(
        "page_id", "payload", "payload_digest", F.when(older, F.col("_first")).alias("refers_to"), "url",
        (F.col("_first").isNotNull() & ~older).alias("referred_to"),
    )


def _response_id(page_id: int, digest: str) -> uuid.UUID:
    """Id of the response that revisits of a page refer to: known wherever they are written."""
    return uuid.uuid5(uuid.NAMESPACE_OID, f"{page_id}:{digest}")


def _record(date: str, own_id: uuid.UUID, page_id: int | None, payload: bytes, digest: str, refers_to: int | None, url: str | None) -> bytes:
    target = quote(url, safe=_URI_SAFE) if url else f"urn:page:{page_id}" if page_id is not None else f"urn:uuid:{own_id}"
    head = ["WARC/1.1", f"WARC-Record-ID: <urn:uuid:{own_id}>", f"WARC-Date: {date}", f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    block = b""
    if refers_to is None:
        block = _HTTP.format(len(payload)).encode() + payload
        head += ["WARC-Type: response", "Content-Type: application/http;msgtype=response"]
    else:
        head += ["WARC-Type: revisit", f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:uuid:{_response_id(refers_to, digest)}>", f"X-Refers-To-Page-ID: {refers_to}"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(sample: list[bytes]) -> zstandard.ZstdCompressionDict:
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample, k=200, d=8)
    except zstandard.ZstdError:  # too few records, or too little that repeats: their bytes are the dictionary
        share = max(1, DICTIONARY_BYTES // len(sample))
        return zstandard.ZstdCompressionDict(b"".join(r[:share] for r in sample)[:DICTIONARY_BYTES], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def _archives(date: str, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of pages to archives, one archive a row, of ``most`` bytes and what the last record is over."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[bytes]:
        given: set[uuid.UUID] = set()
        for batch in batches:
            for page_id, payload, digest, refers_to, url, referred_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = _response_id(page_id, digest) if referred_to and page_id is not None else uuid.uuid4()
                if referred_to:
                    own = uuid.uuid4() if own in given else own
                    given.add(own)
                yield _record(date, own, page_id, payload, digest, refers_to, url)

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, sample, size = records(batches), [], 0
        for record in rest:
            sample.append(record)
            size += len(record)
            if size >= SAMPLE_BYTES:
                break
        if not sample:
            return
        trained = _dictionary(sample)
        raw = trained.as_bytes()
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained)
        lead = DICTIONARY_FRAME.to_bytes(4, "little") + len(raw).to_bytes(4, "little") + raw
        between = EMPTY_FRAME.encode()
        archive = bytearray(lead)
        for record in chain(_emptied(sample), rest):
            if len(archive) >= most:
                yield pa.RecordBatch.from_pydict({"archive": pa.array([bytes(archive)], pa.binary())})
                archive = bytearray(lead)
            # No separator after the dictionary: the length is in its frame.
            archive += (between if len(archive) > len(lead) else b"") + compressor.compress(record)
        yield pa.RecordBatch.from_pydict({"archive": pa.array([bytes(archive)], pa.binary())})

    return archives


def _emptied(records: list[bytes]) -> Iterator[bytes]:
    records.reverse()
    while records:
        yield records.pop()


def write_archives(
    pages: DataFrame, folder: str, page_id: str = "page_id", payload: str = "html", url: str = "url", date: datetime | None = None
) -> None:
    """Archive every row of ``pages`` in ``folder``; a null payload is empty.

    ``date`` is when the pages were captured, by default the time of this call.
    """
    stamp = (date or datetime.now(timezone.utc)).astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    archives = decide_revisits(pages, page_id, payload, url).mapInArrow(_archives(stamp, ARCHIVE_BYTES), "archive binary")
    # The cast keeps the bytes as they are; the writer puts them out unchanged, one row a file.
    out = archives.select(F.col("archive").cast("string")).write.option("lineSep", EMPTY_FRAME).option("compression", "none")
    out.option("maxRecordsPerFile", 1).text(folder)


_FOUND = pa.schema({"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()})


def _number(fields: dict[bytes, bytes], name: bytes) -> int | None:
    return int(fields[name]) if name in fields else None


def _records(archive: bytes) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    """Header fields and payload of each record, one in memory at a time."""
    if not archive:  # what Spark writes for a table without rows
        return
    length = int.from_bytes(archive[4:8], "little")
    if int.from_bytes(archive[:4], "little") != DICTIONARY_FRAME:
        raise ValueError("the archive does not begin with a dictionary frame")
    trained = zstandard.ZstdCompressionDict(archive[8 : 8 + length])
    reader = zstandard.ZstdDecompressor(dict_data=trained).stream_reader(io.BytesIO(archive), read_across_frames=True)
    with io.BufferedReader(reader, 1 << 18) as stream:
        while line := stream.readline():
            head = [line]
            while (line := stream.readline()) not in (b"\r\n", b""):
                head.append(line)
            fields = dict(_FIELD.findall(b"".join(head)))
            content = stream.read(int(fields[b"Content-Length"]))
            if stream.read(4) != b"\r\n\r\n":
                raise ValueError("a record does not end where its length says")
            yield fields, content.partition(b"\r\n\r\n")[2]


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    for batch in batches:
        for archive in batch.column(0):
            rows = {name: [] for name in _FOUND.names}
            for fields, content in _records(archive.as_py()):
                kind = fields[b"WARC-Type"].decode()
                digest = fields[b"WARC-Payload-Digest"].removeprefix(b"sha1:").decode()
                if kind == "response" and hashlib.sha1(content).hexdigest() != digest:
                    raise ValueError(f"record {fields[b'WARC-Record-ID']!r} is damaged")
                found = (_number(fields, b"X-Page-ID"), len(content) if kind == "response" else None, digest, kind)
                for name, value in zip(rows, (*found, _number(fields, b"X-Refers-To-Page-ID")), strict=True):
                    rows[name].append(value)
            yield pa.RecordBatch.from_pydict(rows, schema=_FOUND)


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the archives in ``folder``.

    Returns page_id, payload_bytes, payload_digest, record_type, refers_to.  Digests of
    responses are checked against their content; a revisit's size is its response's.
    """
    files = spark.read.format("binaryFile").load(folder).select("content")
    parsed = written(files.mapInArrow(_parsed, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"))
    # Repeated page ids may give two responses of one id, hence the digest and the grouping.
    sizes = (
        parsed.where("record_type = 'response'").groupBy(F.col("page_id").alias("refers_to"), "payload_digest")
        .agg(F.max("payload_bytes").alias("_size"))
    )
    wanted = parsed.where("record_type = 'revisit'").select("refers_to", "payload_digest").distinct()
    return parsed.join(sizes.join(wanted, ["refers_to", "payload_digest"]), ["refers_to", "payload_digest"], "left").select(
        "page_id", F.coalesce("payload_bytes", "_size").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )


def archive_round_trip(pages: DataFrame, page_id: str = "page_id", payload: str = "html", url: str = "url") -> DataFrame:
    """Write ``pages`` to archives in the shared folder and return what reading them gives."""
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/matrixlens-llm/{spark.sparkContext.applicationId}/warc-{uuid.uuid4().hex}"
    write_archives(pages, folder, page_id, payload, url)
    return read_archives(spark, folder)
