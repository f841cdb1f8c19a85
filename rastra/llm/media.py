"""Media columns: Netpbm and BMP images as arrays, area-resized, with NPY tiles and difference hashes."""

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

from rastra.llm.common import slices, texts
from rastra.storage import settle


def encode_netpbm(image: np.ndarray) -> bytes:
    """Binary PGM of an ``(h, w)`` array, or PPM of an ``(h, w, 3)`` one, with 8-bit samples."""
    kind = b"P5" if image.ndim == 2 else b"P6"
    return b"%s\n%d %d\n255\n" % (kind, image.shape[1], image.shape[0]) + np.ascontiguousarray(image, np.uint8).tobytes()


def decode_netpbm(data: bytes) -> np.ndarray:
    """Array of a PBM, PGM or PPM in text or binary form, with samples of 8 or 16 bits."""
    kind, fields, at = data[:2], [], 2
    if kind not in (b"P1", b"P2", b"P3", b"P4", b"P5", b"P6"):
        raise ValueError("not a Netpbm image")
    n_fields = 2 if kind in (b"P1", b"P4") else 3
    while len(fields) < n_fields:
        while data[at : at + 1].isspace():
            at += 1
        if data[at : at + 1] == b"#":
            at = data.index(b"\n", at)
            continue
        end = at
        while data[end : end + 1].isdigit():
            end += 1
        if end == at:
            raise ValueError("broken Netpbm header")
        fields.append(int(data[at:end]))
        at = end
    width, height, top = fields[0], fields[1], fields[2] if n_fields == 3 else 1
    if not (width and height and 0 < top < 1 << 16):
        raise ValueError("Netpbm image without pixels, or with samples of over 16 bits")
    depth = 3 if kind in (b"P3", b"P6") else 1
    n = width * height * depth
    if kind in (b"P5", b"P6"):
        samples = np.frombuffer(data, np.uint8 if top < 256 else ">u2", n, at + 1)
    elif kind == b"P4":
        row = (width + 7) // 8
        bits = np.frombuffer(data, np.uint8, row * height, at + 1).reshape(height, row)
        samples = 1 - np.unpackbits(bits, axis=1)[:, :width].ravel()
    else:
        body = b"\n".join(line.partition(b"#")[0] for line in data[at:].split(b"\n"))
        if kind == b"P1":
            samples = 1 - np.array([c - 48 for c in body if c in b"01"], np.int64)
        else:
            samples = np.array(body.split(), dtype=np.int64)
        if len(samples) < n:
            raise ValueError("Netpbm image is cut short")
        samples = samples[:n]
    if top != 255:
        samples = (samples.astype(np.int64) * 255 + top // 2) // top
    shape = (height, width, 3) if depth == 3 else (height, width)
    return samples.astype(np.uint8).reshape(shape)


def encode_bmp(image: np.ndarray) -> bytes:
    """Uncompressed BMP: 8 bits with a grey palette, or 24 bits for colour; rows from the bottom."""
    height, width = image.shape[:2]
    depth = 1 if image.ndim == 2 else 3
    row = (width * depth + 3) // 4 * 4
    body = np.zeros((height, row), np.uint8)
    body[:, : width * depth] = (image if depth == 1 else image[:, :, ::-1]).reshape(height, -1)
    palette = np.repeat(np.arange(256, dtype="<u4") * 0x010101, 1).astype("<u4").tobytes() if depth == 1 else b""
    offset = 54 + len(palette)
    head = struct.pack("<2sIHHI", b"BM", offset + body.size, 0, 0, offset)
    info = struct.pack("<IiiHHIIiiII", 40, width, height, 1, 8 * depth, 0, body.size, 2835, 2835, 256 if depth == 1 else 0, 0)
    return head + info + palette + body[::-1].tobytes()


def decode_bmp(data: bytes) -> np.ndarray:
    """Array of an uncompressed BMP of 1, 4, 8, 24 or 32 bits; grey palettes give ``(h, w)``."""
    if data[:2] != b"BM":
        raise ValueError("not a BMP image")
    offset, size = struct.unpack_from("<I", data, 10)[0], struct.unpack_from("<I", data, 14)[0]
    width, height, _, bits, packing = struct.unpack_from("<iiHHI", data, 18)
    used = struct.unpack_from("<I", data, 46)[0]
    if width < 1 or not height:
        raise ValueError("BMP image without pixels")
    if packing not in (0, 3) or bits not in (1, 4, 8, 24, 32):
        raise ValueError("this kind of BMP isn't supported")
    down, height = height < 0, abs(height)
    row = (width * bits + 31) // 32 * 4
    body = np.frombuffer(data, np.uint8, row * height, offset).reshape(height, row)
    body = body if down else body[::-1]
    if bits >= 24:
        return np.ascontiguousarray(body[:, : width * bits // 8].reshape(height, width, bits // 8)[:, :, 2::-1])
    if bits == 8:
        index = body[:, :width]
    elif bits == 4:
        index = np.stack([body >> 4, body & 15], axis=2).reshape(height, -1)[:, :width]
    else:
        index = np.unpackbits(body, axis=1)[:, :width]
    n = used or 1 << bits
    palette = np.frombuffer(data, np.uint8, 4 * n, 14 + size).reshape(n, 4)[:, 2::-1]
    colours = palette[index]
    return np.ascontiguousarray(colours[:, :, 0]) if (palette == palette[:, :1]).all() else colours


def decode_image(data: bytes) -> np.ndarray:
    return decode_bmp(data) if data[:2] == b"BM" else decode_netpbm(data)


def grey(image: np.ndarray) -> np.ndarray:
    """Luma by the integer weights 299, 587 and 114."""
    if image.ndim == 2:
        return image
    return ((image.astype(np.int64) @ np.array([299, 587, 114]) + 500) // 1000).astype(np.uint8)


def area_resize(image: np.ndarray, height: int, width: int, strip: int = 1 << 14) -> np.ndarray:
    """Mean of the area that each output pixel covers, from an integral image; any ratio, up or down.

    Of the integral image only the rows at output edges are kept, and it is
    summed in strips, so memory doesn't grow with the height.
    """
    h, w = image.shape

    def at(n_in: int, n_out: int) -> tuple[np.ndarray, np.ndarray]:
        edges = np.arange(n_out + 1) * (n_in / n_out)
        low = np.minimum(edges.astype(np.int64), n_in - 1)
        return low, edges - low

    (y, fy), (x, fx) = at(h, height), at(w, width)
    needed = np.unique(np.concatenate([y, y + 1]))
    lines, carry, nth = np.zeros((len(needed), w + 1)), np.zeros(w + 1), 0
    for top in range(0, h + 1, strip):
        part = image[top : top + strip]
        sums = np.zeros((len(part) + 1, w + 1))
        np.cumsum(part, axis=0, dtype=np.float64, out=sums[1:, 1:])
        np.cumsum(sums[1:, 1:], axis=1, out=sums[1:, 1:])
        sums += carry
        while nth < len(needed) and needed[nth] <= top + len(part):
            lines[nth] = sums[needed[nth] - top]
            nth += 1
        carry = sums[-1]
    rows = lines[np.searchsorted(needed, y)] * (1 - fy)[:, None] + lines[np.searchsorted(needed, y + 1)] * fy[:, None]
    both = rows[:, x] * (1 - fx) + rows[:, x + 1] * fx
    area = np.diff(np.diff(both, axis=0), axis=1)
    return np.clip(np.rint(area * (height * width / (h * w))), 0, 255).astype(np.uint8)


def difference_hash(image: np.ndarray) -> str:
    """64 bits as hex: whether each pixel of a 9 x 8 reduction is darker than its right neighbour."""
    small = area_resize(grey(image), 8, 9).astype(np.int16)
    return np.packbits(small[:, 1:] > small[:, :-1]).tobytes().hex()


def npy_tile(image: np.ndarray, edge: int = 16) -> bytes:
    """An ``edge`` x ``edge`` grey reduction in NPY format."""
    out = io.BytesIO()
    np.lib.format.write_array(out, area_resize(grey(image), edge, edge), version=(1, 0), allow_pickle=False)
    return out.getvalue()


def text_media(raw: bytes | None, unit: int = 576, form: str = "pgm") -> tuple[bytes, int]:
    """A text's bytes, padded with 255 to a positive multiple of ``unit``, as the samples of an image.

    The image is the square root of ``unit`` wide, a BMP or a PGM; with a form
    of ``both`` texts of an even number of units become BMP and others PGM.
    Returns the file and the number of bytes before padding.
    """
    raw = raw or b""
    side = int(unit**0.5)
    payload = raw.ljust(max(1, -(-len(raw) // unit)) * unit, b"\xff")
    image = np.frombuffer(payload, np.uint8).reshape(-1, side)
    bmp = form == "bmp" or form == "both" and len(payload) // unit % 2 == 0
    return (encode_bmp if bmp else encode_netpbm)(image), len(raw)


def media_column(docs: DataFrame, text: str = "text", unit: int = 576, form: str = "pgm") -> DataFrame:
    """Adds ``media`` (a Netpbm or BMP file) and ``n_bytes`` of each whole text; null counts as empty.

    Columns of those names in the input give way; equal texts have equal files,
    repeated rows are kept, and an empty table gives an empty result.
    """

    @F.arrow_udf("struct<media: binary, n_bytes: bigint>")
    def store(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in slices(batches):
            made = [text_media(raw, unit, form) for raw in texts(batch)]
            yield pa.StructArray.from_arrays(
                [pa.array([m for m, _ in made], pa.binary()), pa.array([n for _, n in made], pa.int64())], ["media", "n_bytes"]
            )

    made = docs.select(
        *[docs[f"`{c}`"] for c in docs.columns if c not in ("media", "n_bytes")],
        store.asNondeterministic()(docs[f"`{text}`"].cast("binary")).alias("_made"),
    )
    return made.select("*", "_made.media", "_made.n_bytes").drop("_made")


_FEATURES = pa.struct(
    [
        ("payload_bytes", pa.int64()),
        ("payload_sha256", pa.string()),
        ("tail_crc32", pa.int64()),
        ("media_bytes", pa.int64()),
        ("media_sha256", pa.string()),
        ("feature", pa.string()),
        ("tile", pa.binary()),
        ("height", pa.int32()),
        ("width", pa.int32()),
        ("error", pa.string()),
    ]
)


def media_features(media: DataFrame, column: str = "media", edge: int = 16) -> DataFrame:
    """Decodes a column of image files and adds one struct, ``found``, of what is in them.

    ``payload_*`` describe the samples read back, ``media_*`` the file,
    ``feature`` is the difference hash and ``tile`` the NPY tile. A null or
    broken file gives nulls and an ``error`` instead of ending the job.
    """

    def read(data: bytes | None) -> dict:
        if data is None:
            return {"error": "null"}
        try:
            image = decode_image(data)
            made = {"feature": difference_hash(image), "tile": npy_tile(image, edge)}
        except (ValueError, struct.error, IndexError, OverflowError) as e:
            return {"media_bytes": len(data), "media_sha256": hashlib.sha256(data).hexdigest(), "error": str(e)}
        payload = image.tobytes()
        return made | {
            "payload_bytes": len(payload),
            "payload_sha256": hashlib.sha256(payload).hexdigest(),
            "tail_crc32": zlib.crc32(payload[-32:]),
            "media_bytes": len(data),
            "media_sha256": hashlib.sha256(data).hexdigest(),
            "height": image.shape[0],
            "width": image.shape[1],
        }

    @F.arrow_udf("struct<payload_bytes: bigint, payload_sha256: string, tail_crc32: bigint, media_bytes: bigint, media_sha256: string, feature: string, tile: binary, height: int, width: int, error: string>")
    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in slices(batches):
            yield pa.array([read(data) for data in texts(batch)], type=_FEATURES)

    return media.select(*[media[f"`{c}`"] for c in media.columns if c != "found"], features.asNondeterministic()(media[f"`{column}`"]).alias("found"))


def stored_media(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", unit: int = 576, form: str = "both") -> DataFrame:
    """Writes every text as an image in a media table, reads it back, and writes what is made of the images in another.

    One row a document with ``doc_id, n_bytes`` and the fields of
    :func:`media_features`, NPY tiles among them. Both tables are Parquet in the
    shared folder; the result is the second one. Empty and null texts are one
    unit of padding; repeated rows are kept; an empty table gives an empty
    result.
    """
    narrow = docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{text}`"].alias("text"))
    table = settle(media_column(narrow, "text", unit, form).drop("text"), "media", compression="zstd")
    return settle(media_features(table).select("doc_id", "n_bytes", "found.*"), "media_tiles", compression="zstd")
