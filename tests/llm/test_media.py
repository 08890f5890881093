import hashlib
import io
import struct

import numpy as np
import pytest

from shelfmark.llm import media

from .fixtures import EDGES, edge_docs, no_docs


def bmp(image, bits=24, top_down=False):
    h, w = image.shape[:2]
    if bits == 24:
        rows = [r[:, ::-1].tobytes() for r in image]
        palette = b""
    else:
        rows, palette = [r.tobytes() for r in image], b"".join(bytes((i, i, i, 0)) for i in range(256))
    rows = [r + b"\0" * (-len(r) % 4) for r in (rows if top_down else rows[::-1])]
    place = 54 + len(palette)
    body = b"".join(rows)
    return b"BM" + struct.pack("<IHHI", place + len(body), 0, 0, place) + struct.pack("<IiiHHIIiiII", 40, w, -h if top_down else h, 1, bits, 0, len(body), 0, 0, 0, 0) + palette + body


def test_decoders_read_what_was_written():
    rng = np.random.default_rng(1)
    grey, rgb = rng.integers(0, 256, (7, 5), dtype=np.uint8), rng.integers(0, 256, (7, 5, 3), dtype=np.uint8)
    assert (media.decode(media.encode_pgm(grey))[:, :, 0] == grey).all()
    assert (media.decode(b"P6 # c\n5 7\n255\n" + rgb.tobytes()) == rgb).all()
    assert (media.decode(b"P3\n5 7 255\n" + " ".join(map(str, rgb.ravel())).encode()) == rgb).all()
    assert (media.decode(b"P2\n5 7\n255 " + " ".join(map(str, grey.ravel())).encode())[:, :, 0] == grey).all()
    wide = (grey.astype(np.uint16) * 200).astype(">u2")
    assert (media.decode(b"P5 5 7 65535\n" + wide.tobytes())[:, :, 0] == wide).all()
    bits = grey > 127
    packed = np.packbits(~bits, axis=1).tobytes()
    assert ((media.decode(b"P4 5 7\n" + packed)[:, :, 0] == 255) == bits).all()
    assert ((media.decode(b"P1\n5 7\n" + "".join("01"[int(not b)] for b in bits.ravel()).encode())[:, :, 0] == 255) == bits).all()
    for down in (False, True):
        assert (media.decode(bmp(rgb, 24, down)) == rgb).all() and (media.decode(bmp(grey, 8, down))[:, :, 0] == grey).all()


@pytest.mark.parametrize("data", [b"", b"P", b"P5", b"P5 3 3 255\n12", b"P9 1 1 1\n1", b"BM" + b"\0" * 60, b"P6 0 5 255\n", b"\x89PNG", b"P2 2 1 255 300 4", b"P2 2 1 255 -5 4", b"P5 2 1 99\n\xff\x01"])
def test_broken_images_are_value_errors(data):
    with pytest.raises(ValueError):
        media.decode(data)


def brute_resize(image, height, width):
    """Every output pixel as the mean of its area, by a fine grid."""
    big = np.kron(image.astype(float), np.ones((height, width)))
    h, w = image.shape
    return big.reshape(height, h, width, w).mean((1, 3))


def test_area_resize_is_the_mean_of_areas():
    rng = np.random.default_rng(2)
    for h, w, a, b in ((24, 24, 8, 9), (5, 7, 8, 9), (1, 1, 3, 2), (13, 24, 16, 16)):
        image = rng.integers(0, 256, (h, w))
        assert np.allclose(media.area_resize(image, a, b), brute_resize(image, a, b))


def test_tiles_are_npy_and_hashes_compare_neighbours():
    image = np.tile(np.arange(0, 180, 20, dtype=np.uint8), (8, 1))
    f = media.features(media.encode_pgm(image), 8, 9)
    assert (np.load(io.BytesIO(f["tile"]))[:, :, 0] == image).all() and f["dhash"] == "f" * 16
    assert media.features(media.encode_pgm(image[:, ::-1].copy()), 8, 9)["dhash"] == "0" * 16


def test_text_round_trip_and_edges(spark):
    docs = edge_docs(spark, {"media": "clash", "n_bytes": -1})
    stored = media.text_images(docs)
    got = media.image_digest(stored).collect()
    want = [(i, t or "") for i, t, *_ in EDGES]
    assert len(got) == len(want)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    for i, t in want:
        payload = media.pad(t.encode())
        assert len(payload) % 576 == 0 and payload
        assert any(r["n_bytes"] == len(t.encode()) and r["payload_bytes"] == len(payload) and r["payload_sha256"] == hashlib.sha256(payload).hexdigest() for r in by[i])
    assert len({tuple(r)[1:] for r in got if r["doc_id"] in (1, 2)}) == 1
    assert media.image_digest(media.text_images(no_docs(spark))).count() == 0


def test_media_columns_keep_rows(spark):
    ok = bytearray(media.encode_pgm(np.zeros((3, 3), np.uint8)))
    df = spark.createDataFrame([(1, ok, "x"), (2, None, "x"), (3, bytearray(b"junk"), "x")], "id int, media binary, dhash string")
    got = {r["id"]: r for r in media.media_columns(df).collect()}
    assert got[1]["height"] == 3 and got[1]["error"] is None and got[2]["error"] == "null" and got[3]["tile"] is None and got[3]["dhash"] is None


def test_masks_of_bitmaps():
    rng = np.random.default_rng(3)
    rgba = rng.integers(0, 256, (3, 5, 4), dtype=np.uint8)
    for place in ((0, 1, 2, 3), (2, 1, 0, 3), (3, 2, 1, 0)):
        stored = np.zeros_like(rgba)
        for channel, at in enumerate(place):
            stored[:, :, at] = rgba[:, :, channel]
        masks = struct.pack("<IIII", *[0xFF << (8 * k) for k in place])
        body = stored[::-1].tobytes()
        data = b"BM" + struct.pack("<IHHI", 70 + len(body), 0, 0, 70) + struct.pack("<IiiHHIIiiII", 56, 5, 3, 1, 32, 3, len(body), 0, 0, 0, 0) + masks + body
        assert (media.decode(data) == rgba).all()
    with pytest.raises(ValueError):
        media.decode(data[:54] + struct.pack("<IIII", 0x1F, 0x3E0, 0x7C00, 0) + data[70:])


def test_texts_are_stored_in_both_formats(spark):
    docs = spark.range(40).selectExpr("id as doc_id", "concat('text ', repeat('ab', cast(id as int))) as text")
    stored = {r["doc_id"]: bytes(r["media"]) for r in media.text_images(docs).collect()}
    assert {m[:2] for m in stored.values()} == {b"BM", b"P5"}
    for r in media.image_digest(media.text_images(docs)).collect():
        payload = media.pad(f"text {'ab' * r['doc_id']}".encode())
        assert r["payload_sha256"] == hashlib.sha256(payload).hexdigest() and r["media_sha256"] == hashlib.sha256(stored[r["doc_id"]]).hexdigest()
        image = np.frombuffer(payload, np.uint8).reshape(-1, 24)
        tile = np.load(io.BytesIO(bytes(r["tile"])))[:, :, 0]
        assert np.abs(tile - brute_resize(image, 16, 16)).max() <= 0.5 + 1e-6
        small = np.rint(brute_resize(image, 8, 9) * 256)
        assert r["feature"] == "".join(f"{sum(int(x < y) << (7 - k) for k, (x, y) in enumerate(zip(row, row[1:]))):02x}" for row in small)


def test_damaged_images_keep_their_rows(spark):
    df = spark.createDataFrame([(1, 3, None), (2, 3, bytearray(b"BMjunk")), (3, 0, bytearray(media.encode_text(media.pad(b""))))], "doc_id long, n_bytes long, media binary")
    got = {r["doc_id"]: r for r in media.image_digest(df).collect()}
    assert got[1]["error"] == "null" and got[2]["error"] and got[2]["payload_bytes"] is None and got[3]["payload_bytes"] == 576 and got[3]["error"] is None
