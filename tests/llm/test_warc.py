import hashlib
import struct

import pytest
import zstandard
from pyspark.sql import functions as F

from shelfmark.llm import warc

SCHEMA = "page_id long, url string, html string, digest string"


def pages(spark):
    big, other = "x" * 1500, "é" * 700
    rows = [(1, "http://a/1", big, ""), (2, "http://a/ü\r\nX: y", big, ""), (5, None, big, ""), (3, "u", other, ""), (4, "u", None, ""), (6, "u", "", ""), (7, "u", "short", ""), (8, "u", "short", ""), (9, "u", big, ""), (9, "u", big, ""), (None, "u", big, "")]
    return spark.createDataFrame(rows, SCHEMA), rows


def test_round_trip_against_brute_force(spark):
    df, rows = pages(spark)
    got = warc.read_archives(warc.archive_pages(df, archive_bytes=4000), payloads=True).collect()
    assert len(got) == len(rows) and not [r for r in got if r["error"]]
    want = []
    for i, _, html, _ in rows:
        p = (html or "").encode()
        same = [j for j, _, h, _ in rows if (h or "").encode() == p and j is not None]
        kept = max(same) if len(p) >= 1000 and same else None
        revisit = kept is not None and i != kept
        want.append((i, len(p), hashlib.sha1(p).hexdigest(), "revisit" if revisit else "response", kept if revisit else None))
    assert sorted(want, key=str) == sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got), key=str)
    assert all(bytes(r["payload"]).decode() == next((h or "") for i, _, h, _ in rows if i == r["page_id"]) for r in got if r["record_type"] == "response")
    assert warc.read_archives(warc.archive_pages(df.limit(0))).count() == 0


def test_files_and_damage(spark, tmp_path):
    df, _ = pages(spark)
    blob = bytes(warc.archive_pages(df.coalesce(1)).first()["bytes"])
    assert struct.unpack_from("<I", blob)[0] == warc.DICTIONARY_FRAME
    (tmp_path / "a.warc.zst").write_bytes(blob)
    (tmp_path / "cut.warc.zst").write_bytes(blob[:-9])
    (tmp_path / "no.warc.zst").write_bytes(b"junk")
    (tmp_path / "empty.warc.zst").write_bytes(b"")
    got = warc.read_files(spark, f"file://{tmp_path}").groupBy(F.regexp_extract("archive", "([a-z]+).warc", 1).alias("a")).agg(F.count("*").alias("n"), F.count("error").alias("bad")).collect()
    assert {r["a"]: (r["n"], r["bad"]) for r in got} == {"a": (11, 0), "cut": (11, 1), "no": (1, 1)}


def test_dictionary_forms():
    record = warc.build_record(1, "u", b"abc" * 50, hashlib.sha1(b"abc" * 50).hexdigest(), None)
    raw = b"WARC/1.1 dictionary" * 4
    d = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    frame = zstandard.ZstdCompressor(dict_data=d).compress(record)
    packed = zstandard.ZstdCompressor().compress(raw)
    skip = struct.pack("<II", 0x184D2A50, 3) + b"xyz"
    for stored in (raw, packed):
        archive = struct.pack("<II", warc.DICTIONARY_FRAME, len(stored)) + stored + frame + skip + frame
        assert [c for _, c in warc.frames(archive)] == [record, record]
    assert [c for _, c in warc.frames(zstandard.ZstdCompressor().compress(record))] == [record]


@pytest.mark.parametrize("change", [(b"WARC/1.1", b"WARC/9.9"), (b"Content-Length: ", b"Content-Length: 1"), (b"WARC-Date", b"X-Date"), (b"abcabc", b"abcabd"), (b"WARC-Type: ", b"WARC-Type ")])
def test_records_are_validated(change):
    record = warc.build_record(1, "u", b"abc" * 50, hashlib.sha1(b"abc" * 50).hexdigest(), None)
    assert warc.parse_page(record)["payload"] == b"abc" * 50
    with pytest.raises(ValueError):
        warc.parse_page(record.replace(*change, 1))
