"""Media columns: Netpbm and BMP images decoded to arrays, resized by area, hashed and written as NPY tiles.

Decoders take P1 to P6 (plain and raw, one or two bytes a sample) and uncompressed BMP of 1, 4, 8, 24 and 32 bits,
bottom-up or top-down, 32 bits also with masks of whole bytes. `area_resize` averages over areas by an integral image, with fractions of pixels at the
edges. `difference_hash` compares neighbours of the 9 by 8 tile. `encode_npy` writes the tile in NPY format 1.0.

Defined cases: a null image gives null columns and the error "null"; bytes that are no image, are cut short,
declare no pixels or hold samples above their largest value give null columns and a message, and never end the job. Equal bytes give equal values. Other
columns are kept; of names that clash, the input's is replaced.
"""

from __future__ import annotations

import hashlib
import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, text_chunks

PAD = 576
WIDTH = 24
_SPACE = b" \t\n\r\x0b\x0c"


def _netpbm_header(data: bytes, count: int) -> tuple[list[int], int]:
    """The header's numbers and the place behind the one white space that ends it; comments run to the line's end."""
    out: list[int] = []
    at = 2
    while len(out) < count:
        while at < len(data) and (data[at] in _SPACE or data[at] == 35):
            if data[at] == 35:
                end = data.find(b"\n", at)
                at = len(data) if end < 0 else end
            at += 1
        end = at
        while end < len(data) and 48 <= data[end] <= 57:
            end += 1
        if end == at:
            raise ValueError("netpbm: header is cut short")
        out.append(int(data[at:end]))
        at = end
    return out, at + 1


def decode_netpbm(data: bytes) -> np.ndarray:
    """(height, width, channels) of uint8 or uint16. In bitmaps 1 is black and becomes 0, white becomes 255."""
    kind = data[1] - 48
    bitmap, channels = kind in (1, 4), 3 if kind in (3, 6) else 1
    numbers, at = _netpbm_header(data, 2 if bitmap else 3)
    width, height = numbers[:2]
    top = 1 if bitmap else numbers[2]
    if not (width > 0 and height > 0 and 0 < top < 65536):
        raise ValueError("netpbm: no pixels")
    n = width * height * channels
    if kind == 1:
        flat = np.frombuffer(data[at - 1 :], np.uint8)
        flat = flat[(flat == 48) | (flat == 49)][:n] - 48
    elif kind in (2, 3):
        flat = np.array(data[at - 1 :].split(None, n)[:n], np.int64)
    elif kind == 4:
        stride = (width + 7) // 8
        rows = np.frombuffer(data, np.uint8, min(stride * height, len(data) - at), at)
        if rows.size < stride * height:
            raise ValueError("netpbm: samples are cut short")
        flat = np.unpackbits(rows.reshape(height, stride), axis=1)[:, :width].ravel()
    else:
        wide = np.dtype(">u2") if top > 255 else np.dtype(np.uint8)
        if len(data) - at < n * wide.itemsize:
            raise ValueError("netpbm: samples are cut short")
        flat = np.frombuffer(data, wide, n, at)
    if flat.size < n:
        raise ValueError("netpbm: samples are cut short")
    if flat.max() > top or flat.min() < 0:
        raise ValueError("netpbm: a sample lies beyond the largest value")
    if bitmap:
        flat = (1 - flat) * 255
    return flat.astype(np.uint16 if top > 255 else np.uint8).reshape(height, width, channels)


def _masked(data: bytes, header: int, bits: int) -> list[int]:
    """Which byte of a pixel holds red, green, blue and, in headers that name it, alpha. Masks of other shapes are not read."""
    if bits != 32 or len(data) < 66:
        raise ValueError("bmp: masks need 32 bits")
    masks = struct.unpack_from("<IIII", data, 54) if header >= 56 and len(data) >= 70 else (*struct.unpack_from("<III", data, 54), 0)
    whole = {0xFF << (8 * k): k for k in range(4)}
    if any(m not in whole for m in masks[:3]) or masks[3] and masks[3] not in whole or len({*masks}) < 4:
        raise ValueError("bmp: these masks are not read")
    return [whole[m] for m in masks if m]


def decode_bmp(data: bytes) -> np.ndarray:
    """(height, width, channels) of uint8; palettes are applied, blue-green-red becomes red-green-blue."""
    if len(data) < 54:
        raise ValueError("bmp: header is cut short")
    place, header, width, height, _, bits, packing = struct.unpack_from("<10xIIiiHHI", data)
    rows, colours = abs(height), struct.unpack_from("<46xI", data)[0]
    if packing not in (0, 3) or bits not in (1, 4, 8, 24, 32) or width <= 0 or not rows:
        raise ValueError("bmp: this form is not read")
    stride = (width * bits + 31) // 32 * 4
    if len(data) - place < stride * rows:
        raise ValueError("bmp: samples are cut short")
    raw = np.frombuffer(data, np.uint8, stride * rows, place).reshape(rows, stride)
    if bits >= 24:
        order = [2, 1, 0, 3][: bits // 8] if packing == 0 else _masked(data, header, bits)
        image = raw[:, : width * bits // 8].reshape(rows, width, bits // 8)[:, :, order]
    elif packing == 3:
        raise ValueError("bmp: masks without colours of their own")
    else:
        n = colours or 1 << bits
        palette = np.frombuffer(data, np.uint8, 4 * n, 14 + header).reshape(n, 4)[:, 2::-1]
        index = raw if bits == 8 else np.unpackbits(raw, axis=1) if bits == 1 else np.stack([raw >> 4, raw & 15], 2).reshape(rows, -1)
        index = index[:, :width]
        if index.max() >= n:
            raise ValueError("bmp: a colour is not in the palette")
        image = palette[index]
        if (palette[:, :1] == palette).all():
            image = image[:, :, :1]
    return image if height < 0 else image[::-1]


def decode(data: bytes) -> np.ndarray:
    if data[:2] == b"BM":
        return decode_bmp(data)
    if len(data) > 2 and data[:1] == b"P" and 49 <= data[1] <= 54:
        return decode_netpbm(data)
    raise ValueError("neither Netpbm nor BMP")


def encode_pgm(samples: np.ndarray) -> bytes:
    """Raw grey map (P5) of a (height, width) array of uint8."""
    return b"P5\n%d %d\n255\n" % (samples.shape[1], samples.shape[0]) + samples.tobytes()


def encode_bmp(samples: np.ndarray) -> bytes:
    """Grey bitmap of 8 bits with a palette, bottom-up, of a (height, width) array of uint8."""
    height, width = samples.shape
    rows = np.zeros((height, -(-width // 4) * 4), np.uint8)
    rows[:, :width] = samples[::-1]
    palette = np.repeat(np.arange(256, dtype=np.uint8), 4).reshape(256, 4)
    palette[:, 3] = 0
    place = 54 + palette.size
    return struct.pack("<2sIHHIIiiHHIIiiII", b"BM", place + rows.size, 0, 0, place, 40, width, height, 1, 8, 0, rows.size, 0, 0, 256, 0) + palette.tobytes() + rows.tobytes()


def _edges(integral: np.ndarray, n: int) -> np.ndarray:
    """The integral along its first axis at n + 1 even cuts, between pixels by linear interpolation."""
    size = integral.shape[0] - 1
    low, part = np.divmod(np.arange(n + 1) * size, n)
    high = np.minimum(low + 1, size)
    part = (part / n).reshape(-1, *[1] * (integral.ndim - 1))
    return integral[low] * (1 - part) + integral[high] * part


def area_resize(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Mean over each area of the image that an output pixel covers, by an integral image; float64."""
    rows, columns = image.shape[:2]
    integral = np.zeros((rows + 1, columns + 1, *image.shape[2:]))
    np.cumsum(image, axis=0, dtype=np.float64, out=integral[1:, 1:])
    np.cumsum(integral[1:, 1:], axis=1, out=integral[1:, 1:])
    cut = _edges(integral, height)
    cut = np.swapaxes(_edges(np.swapaxes(cut, 0, 1), width), 0, 1)
    sums = cut[1:, 1:] - cut[:-1, 1:] - cut[1:, :-1] + cut[:-1, :-1]
    return sums * (height * width / (rows * columns))


def grey(image: np.ndarray) -> np.ndarray:
    if image.ndim == 2 or image.shape[2] == 1:
        return image.reshape(image.shape[:2])
    return image[:, :, :3] @ np.array([0.299, 0.587, 0.114])


def difference_hash(tile: np.ndarray) -> str:
    """64 bits as hex of an 8 by 9 tile: is a value below its right neighbour, rows from the top."""
    return np.packbits(tile[:, :-1] < tile[:, 1:]).tobytes().hex()


def encode_npy(array: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.lib.format.write_array(out, np.ascontiguousarray(array), (1, 0), allow_pickle=False)
    return out.getvalue()


def features(data: bytes, height: int = 16, width: int = 16, digests: bool = False) -> dict:
    """The columns of one image, decoded once."""
    image = decode(data)
    tile = np.clip(np.rint(area_resize(image, height, width)), 0, 65535).astype(image.dtype)
    out = {
        "height": image.shape[0],
        "width": image.shape[1],
        "channels": image.shape[2],
        "tile": encode_npy(tile),
        "dhash": difference_hash(np.rint(area_resize(grey(image), 8, 9) * 256)),
    }
    if digests:
        payload = image.tobytes()
        out |= {
            "payload_bytes": len(payload),
            "payload_sha256": hashlib.sha256(payload).hexdigest(),
            "tail_crc32": zlib.crc32(payload[-32:]),
            "media_bytes": len(data),
            "media_sha256": hashlib.sha256(data).hexdigest(),
        }
    return out


_FEATURES = {"height": pa.int32(), "width": pa.int32(), "channels": pa.int32(), "tile": pa.binary(), "dhash": pa.string(), "error": pa.string()}
_DIGESTS = {"payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string()}
_NAMES = {pa.int32(): "int", pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}


def media_columns(images: DataFrame, column: str = "media", height: int = 16, width: int = 16, digests: bool = False) -> DataFrame:
    """Adds height, width, channels, tile (NPY), dhash and error, and with digests what the samples and the stored bytes
    come to; one image in memory at a time."""
    made = _FEATURES | (_DIGESTS if digests else {})
    kept = images.drop(*[c for c in made if c in images.columns and c != column])
    names = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(names.index(column)):
                try:
                    data = value.as_py()
                    rows.append({"error": "null"} if data is None else features(data, height, width, digests))
                except (ValueError, struct.error, OverflowError) as problem:
                    rows.append({"error": str(problem)})
            arrays = [pa.array([r.get(k) for r in rows], t) for k, t in made.items()]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*names, *made])

    small_batches(images.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, ", ".join([schema, *[f"{k} {_NAMES[t]}" for k, t in made.items()]]))


def pad(payload: bytes, unit: int = PAD) -> bytes:
    """Bytes 255 are appended up to a positive multiple of unit."""
    return payload + b"\xff" * ((-len(payload)) % unit if payload else unit)


def encode_text(payload: bytes) -> bytes:
    """A padded payload as a grey image 24 samples wide: a grey map, or a bitmap where its checksum is odd."""
    samples = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    return encode_bmp(samples) if zlib.crc32(payload) & 1 else encode_pgm(samples)


def text_images(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every whole text as an image: doc_id, n_bytes, media. A null text is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in text_chunks(batch.column(1)):
                media = [encode_text(pad(data[a:b].tobytes())) for a, b in zip(offsets, offsets[1:])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, end - first), pa.array(np.diff(offsets)), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    small_batches(docs.sparkSession)
    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, f"doc_id {dict(picked.dtypes)['doc_id']}, n_bytes long, media binary")


def image_digest(images: DataFrame) -> DataFrame:
    """What stored images (doc_id, n_bytes, media) come to when they are read back, as the contract asks: digests of the
    samples and of the stored bytes, the difference hash as feature, and the tile. A null or damaged image keeps its row,
    with null columns and the error."""
    seen = media_columns(images.select("doc_id", "n_bytes", "media"), digests=True)
    return seen.select("doc_id", "n_bytes", *_DIGESTS, F.col("dhash").alias("feature"), "tile", "error")
