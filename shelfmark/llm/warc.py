"""WARC archives in Zstandard: a dictionary in the leading skippable frame, then one frame a record.

`archive_pages` makes archives of a few megabytes, one table row each; `read_archives` loads the dictionary, decodes
frame by frame and checks each record: version line, required headers, content length, the two line ends behind the
block, declared digests and, for responses, the HTTP length. A damaged record is reported with its offset and ends
its archive's reading, never the job; `read_files` reads archives that lie as files.

Of records with equal payloads of at least `least` bytes the one with the largest page_id is the response and the
others refer to it. Rows meet by digest in an aggregate; only digests that repeat are joined back.

Defined cases: a null html is an empty payload; a null url is written without a target; pages without an id are
responses unless an equal payload has an id; rows that repeat with the same largest id are all responses; an empty
table gives no archive and no record; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import write_table

#: Fixed values of the formats: a skippable frame that holds a dictionary, a frame, and a finished dictionary.
DICTIONARY_FRAME = 0x184D2A5D
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
DICTIONARY_MAGIC = b"\x37\xa4\x30\xec"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 4 << 20
DICTIONARY_BYTES = 16 << 10
SAMPLE_BYTES = 512 << 10
#: Repeated digests up to this many are broadcast (about 60 bytes each); beyond it Spark joins by shuffle.
BROADCAST_ROWS = 100_000

_DATE = "2000-01-01T00:00:00Z"


def sha1_base32(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def build_record(page_id: int | None, url: str | None, payload: bytes, digest_hex: str, refers_to: int | None, place: str = "") -> bytes:
    """One record. Ids are URNs made from the page id, or from the record's place where there is none, so that equal
    input gives equal bytes."""
    digest = "sha1:" + base64.b32encode(bytes.fromhex(digest_hex)).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    headers = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}' if page_id is not None else f'place:{place}')}>"),
        ("WARC-Date", _DATE),
        ("WARC-Page-ID", "" if page_id is None else str(page_id)),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", digest),
        ("WARC-Block-Digest", sha1_base32(block)),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%~-._")))
    if refers_to is not None:
        headers.append(("WARC-Profile", REVISIT_PROFILE))
        headers.append(("WARC-Refers-To", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{refers_to}')}>"))
        headers.append(("WARC-Refers-To-Page-ID", str(refers_to)))
    head = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def train(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """A dictionary from an archive's first records; their plain bytes where there are too few to train on."""
    sample, size = [], 0
    for r in records:
        sample.append(r[: 16 << 10])
        size += len(sample[-1])
        if size > SAMPLE_BYTES:
            break
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample, level=3, threads=0)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(sample)[:DICTIONARY_BYTES] or b"WARC/1.1", dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def build_archive(records: list[bytes]) -> bytes:
    dictionary = train(records)
    raw = dictionary.as_bytes()
    compressor = zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_content_size=True, write_checksum=True)
    return struct.pack("<II", DICTIONARY_FRAME, len(raw)) + raw + b"".join(map(compressor.compress, records))


def load_dictionary(archive: bytes) -> tuple[zstandard.ZstdCompressionDict | None, int]:
    """The dictionary and where records begin. The frame may hold it plain or compressed; there may be none."""
    if len(archive) < 8 or struct.unpack_from("<I", archive)[0] != DICTIONARY_FRAME:
        return None, 0
    size = struct.unpack_from("<I", archive, 4)[0]
    raw = archive[8 : 8 + size]
    if len(raw) < size:
        raise ValueError("the dictionary is cut short")
    if raw[:4] == FRAME_MAGIC:
        raw = zstandard.ZstdDecompressor().decompressobj().decompress(raw)
    kind = zstandard.DICT_TYPE_FULLDICT if raw[:4] == DICTIONARY_MAGIC else zstandard.DICT_TYPE_RAWCONTENT
    return zstandard.ZstdCompressionDict(raw, dict_type=kind), 8 + size


def frames(archive: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of each frame. Skippable frames between records are passed over."""
    dictionary, at = load_dictionary(archive)
    decompressor = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    view = memoryview(archive)
    while at < len(archive):
        begin = at
        if len(archive) - at >= 8 and 0x184D2A50 <= struct.unpack_from("<I", archive, at)[0] <= 0x184D2A5F:
            at += 8 + struct.unpack_from("<I", archive, at + 4)[0]
            continue
        frame, parts, step = decompressor.decompressobj(), [], 4 << 10
        while not frame.eof:
            if at >= len(archive):
                raise ValueError("a frame is cut short")
            piece = view[at : at + step]
            parts.append(frame.decompress(piece))
            at += len(piece) - len(frame.unused_data)
            step = min(step * 2, 1 << 20)
        yield begin, b"".join(parts)


def parse_record(record: bytes) -> dict:
    """Headers (names in lower case) and block of a record that holds to the format; ValueError otherwise."""
    end = record.find(b"\r\n\r\n")
    if not record.startswith((b"WARC/1.0\r\n", b"WARC/1.1\r\n")) or end < 0:
        raise ValueError("no WARC version line or header end")
    headers: dict[str, str] = {}
    for line in record[:end].decode().split("\r\n")[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise ValueError(f"no header: {line[:40]!r}")
        headers[name.strip().lower()] = value.strip()
    for needed in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if needed not in headers:
            raise ValueError(f"{needed} is missing")
    if not headers["content-length"].isdigit():
        raise ValueError("content-length is no number")
    size = int(headers["content-length"])
    block = record[end + 4 : end + 4 + size]
    if len(block) != size or record[end + 4 + size :] != b"\r\n\r\n":
        raise ValueError("content-length does not fit the record")
    declared = headers.get("warc-block-digest")
    if declared and declared.startswith("sha1:") and sha1_base32(block) != declared:
        raise ValueError("the block's digest differs")
    return {"headers": headers, "block": block}


def parse_page(record: bytes) -> dict:
    """A page's row from its record: payload, its length and digest, checked against what the headers declare."""
    got = parse_record(record)
    headers, block = got["headers"], got["block"]
    head, sep, payload = block.partition(b"\r\n\r\n")
    lengths = [int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
    if not sep or not head.startswith(b"HTTP/") or len(lengths) != 1:
        raise ValueError("no HTTP header")
    declared = headers["warc-payload-digest"].removeprefix("sha1:")
    digest = base64.b32decode(declared).hex()
    revisit = headers["warc-type"] == "revisit"
    if revisit and payload or not revisit and (len(payload) != lengths[0] or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError("the payload differs from its header")
    page, other = headers.get("warc-page-id"), headers.get("warc-refers-to-page-id")
    return {
        "page_id": int(page) if page else None,
        "payload_bytes": lengths[0],
        "payload_digest": digest,
        "record_type": headers["warc-type"],
        "refers_to": int(other) if other else None,
        "url": headers.get("warc-target-uri"),
        "payload": None if revisit else payload,
    }


def mark_revisits(pages: DataFrame, least: int = 1000) -> DataFrame:
    """page_id, url, payload, digest, refers_to of every page."""
    p = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.encode("html", "UTF-8"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    repeated = (
        p.filter(F.octet_length("payload") >= least)
        .groupBy("digest")
        .agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 and kept is not null")
        .drop("n")
        .withColumnRenamed("digest", "same")
    )
    repeated = write_table(repeated, "warc-repeated")
    if repeated.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        repeated = F.broadcast(repeated)
    joined = p.join(repeated, p["digest"] == repeated["same"], "left")
    return joined.select("page_id", "url", "payload", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("kept")), F.col("kept")).alias("refers_to"))


def archive_pages(pages: DataFrame, least: int = 1000, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Archives as rows (archive, n_records, bytes), each from at most archive_bytes of records, or one record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records: list[bytes] = []
        size = count = 0
        task = TaskContext.get().partitionId()

        def flush() -> pa.RecordBatch:
            data = build_archive(records)
            name = hashlib.sha1(data).hexdigest()
            return pa.RecordBatch.from_pydict({"archive": [name], "n_records": pa.array([len(records)], pa.int64()), "bytes": pa.array([data], pa.binary())})

        for batch in batches:
            for i in range(batch.num_rows):
                page, url, payload, digest, refers = (c[i].as_py() for c in batch.columns)
                record = build_record(page, url, bytes(payload), digest, refers, f"{task}/{count}")
                count += 1
                if records and size + len(record) > archive_bytes:
                    yield flush()
                    records, size = [], 0
                records.append(record)
                size += len(record)
        if records:
            yield flush()

    return mark_revisits(pages, least).mapInArrow(run, "archive string, n_records long, bytes binary")


_PAGE = "archive string, offset long, error string, page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def read_archives(archives: DataFrame, payloads: bool = False, name: str = "archive", data: str = "bytes") -> DataFrame:
    """A row a record, with its offset; payload if asked for. Where a frame is damaged the archive ends with an error row."""
    schema = _PAGE + (", payload binary" if payloads else "")
    fields = [f.strip().split(" ") for f in schema.split(",")]
    types = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}

    def rows(label: str, blob: bytes) -> Iterator[dict]:
        try:
            for offset, content in frames(blob):
                try:
                    yield {"archive": label, "offset": offset} | parse_page(content)
                except (ValueError, KeyError) as problem:
                    yield {"archive": label, "offset": offset, "error": str(problem)}
        except (ValueError, zstandard.ZstdError) as problem:
            yield {"archive": label, "error": str(problem)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                blob = batch.column(1)[i].as_py()
                got = list(rows(batch.column(0)[i].as_py(), b"" if blob is None else blob))
                yield pa.RecordBatch.from_arrays([pa.array([r.get(k) for r in got], types[t]) for k, t in fields], names=[k for k, _ in fields])

    return archives.select(name, data).mapInArrow(run, schema)


def read_files(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """Archives that lie as files, by any path that Spark reads."""
    files = spark.read.format("binaryFile").load(path)
    return read_archives(files, payloads, "path", "content")
