"""Tiled and striped TIFF: headers, and single blocks of them by byte range (uncompressed or deflate)."""

from __future__ import annotations

import json
import struct
import zlib
from dataclasses import dataclass, field

import numpy as np

#: Numbers of the tags that are read and written (fixed values of the format).
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, DESCRIPTION, OFFSETS, SAMPLES, STRIP_ROWS, COUNTS, PLANAR = 256, 257, 258, 259, 262, 270, 273, 277, 278, 279, 284
PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILE_OFFSETS, TILE_COUNTS, SAMPLE_FORMAT = 317, 322, 323, 324, 325, 339
PIXEL_SCALE, TIE_POINT, TRANSFORMATION, GEO_KEYS = 33550, 33922, 34264, 34735
#: Struct code of each field type, and numpy kind of each sample format (fixed values of the format).
TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 16: "Q", 17: "q"}
KINDS = {1: "u", 2: "i", 3: "f"}
#: Geo keys with an EPSG code: projected, geographic; and the model type of either (fixed values of the format).
PROJECTED, GEOGRAPHIC, MODEL, RASTER = 3072, 2048, 1024, 1025


@dataclass
class Field:
    kind: int
    count: int
    at: int  # of its values in the file


@dataclass
class Header:
    """What a file's directory says; the blocks' places are looked up when they are wanted."""

    order: str
    big: bool
    fields: dict[int, Field]
    values: dict[int, tuple] = field(default_factory=dict)

    def of(self, tag: int, default: tuple | None = None) -> tuple:
        if tag in self.values:
            return self.values[tag]
        if default is None:
            raise ValueError(f"the file has no tag {tag}")
        return default

    @property
    def size(self) -> tuple[int, int]:
        return self.of(HEIGHT)[0], self.of(WIDTH)[0]

    @property
    def block(self) -> tuple[int, int]:
        height, width = self.size
        if TILE_WIDTH in self.values:
            return self.of(TILE_HEIGHT)[0], self.of(TILE_WIDTH)[0]
        return min(self.of(STRIP_ROWS, (height,))[0], height), width

    @property
    def grid(self) -> tuple[int, int]:
        """Rows and columns of blocks."""
        (height, width), (bh, bw) = self.size, self.block
        return -(-height // bh), -(-width // bw)

    @property
    def bands(self) -> int:
        return self.of(SAMPLES, (1,))[0]

    @property
    def dtype(self) -> np.dtype:
        return np.dtype(f"{self.order}{KINDS[self.of(SAMPLE_FORMAT, (1,))[0]]}{self.of(BITS, (1,))[0] // 8}")

    @property
    def planes(self) -> int:
        """How many planes are stored apart: one, or one a band."""
        return self.bands if self.of(PLANAR, (1,))[0] == 2 else 1

    @property
    def affine(self) -> tuple[float, ...]:
        """``x = a col + b row + c`` and ``y = d col + e row + f``; pixels themselves where the file says nothing."""
        if TRANSFORMATION in self.values:
            m = self.of(TRANSFORMATION)
            return m[0], m[1], m[3], m[4], m[5], m[7]
        if PIXEL_SCALE in self.values and TIE_POINT in self.values:
            (sx, sy, *_), (i, j, _, x, y, *_) = self.of(PIXEL_SCALE), self.of(TIE_POINT)
            return sx, 0.0, x - i * sx, 0.0, -sy, y + j * sy
        return 1.0, 0.0, 0.0, 0.0, 1.0, 0.0

    @property
    def crs(self) -> int | None:
        keys = self.of(GEO_KEYS, ())
        named = {keys[i]: keys[i + 3] for i in range(4, len(keys) - 3, 4) if keys[i + 1] == 0}
        return named.get(PROJECTED, named.get(GEOGRAPHIC))

    @property
    def description(self) -> dict:
        try:
            found = json.loads(self.of(DESCRIPTION, ("{}",))[0])
        except ValueError:
            return {}
        return found if isinstance(found, dict) else {}


def read_header(f) -> Header:
    """The first directory of a file that can seek and read. What is no such TIFF, or one stored in a way that can't be read here, is an error."""
    head = f.read(16)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    if order is None or len(head) < 8:
        raise ValueError("not a TIFF file")
    version = struct.unpack(order + "H", head[2:4])[0]
    if version not in (42, 43):
        raise ValueError("not a TIFF file")
    big = version == 43
    start = struct.unpack(order + ("Q" if big else "I"), head[8:16] if big else head[4:8])[0]
    word, entry = ("Q", 20) if big else ("H", 12)
    f.seek(start)
    n = struct.unpack(order + word, _exactly(f, struct.calcsize(word)))[0]
    raw = _exactly(f, n * entry)
    header = Header(order, big, {})
    for i in range(n):
        tag, kind = struct.unpack_from(order + "HH", raw, i * entry)
        count = struct.unpack_from(order + ("Q" if big else "I"), raw, i * entry + 4)[0]
        if kind not in TYPES:
            continue
        at = start + struct.calcsize(word) + i * entry + (12 if big else 8)
        if count * struct.calcsize(TYPES[kind]) > (8 if big else 4):
            at = struct.unpack_from(order + ("Q" if big else "I"), raw, i * entry + (12 if big else 8))[0]
        header.fields[tag] = Field(kind, count, at)
    for tag, x in header.fields.items():
        if tag not in (OFFSETS, COUNTS, TILE_OFFSETS, TILE_COUNTS):
            header.values[tag] = _values(f, header, x, 0, x.count)
    if header.of(COMPRESSION, (1,))[0] not in (1, 8, 32946) or header.of(PREDICTOR, (1,))[0] not in (1, 2):
        raise ValueError("only uncompressed and deflate files can be read, with no or the horizontal predictor")
    if len(set(header.of(BITS, (1,)))) > 1 or header.of(BITS, (1,))[0] % 8 or header.of(SAMPLE_FORMAT, (1,))[0] not in KINDS:
        raise ValueError("samples must be whole bytes of one kind")
    return header


def _exactly(f, n: int) -> bytes:
    raw = f.read(n)
    if len(raw) < n:
        raise ValueError("the file ends too early")
    return raw


def _values(f, header: Header, x: Field, first: int, n: int) -> tuple:
    code = TYPES[x.kind]
    f.seek(x.at + first * struct.calcsize(code))
    if code == "s":
        return (_exactly(f, n).rstrip(b"\0").decode("utf-8", "replace"),)
    return struct.unpack(f"{header.order}{n}{code}", _exactly(f, n * struct.calcsize(code)))


def read_block_row(f, header: Header, block_row: int, columns: range, bands: list[int]):
    """``block_col, pixels`` (band, row, column) of the wanted columns of a row of blocks; only their bytes are read, and blocks that the file leaves out are passed over."""
    (height, width), (bh, bw), (down, across) = header.size, header.block, header.grid
    tiled = TILE_WIDTH in header.values
    offsets, counts = (header.fields[t] for t in ((TILE_OFFSETS, TILE_COUNTS) if tiled else (OFFSETS, COUNTS)))
    n = len(columns)
    if not n:
        return
    planes = bands if header.planes > 1 else [0]
    starts = {p: (p * down + block_row) * across + columns.start for p in planes}
    places = {p: (_values(f, header, offsets, s, n), _values(f, header, counts, s, n)) for p, s in starts.items()}
    h = min(bh, height - block_row * bh)
    for i, c in enumerate(columns):
        w = min(bw, width - c * bw)
        parts = []
        for p in planes:
            at, size = places[p][0][i], places[p][1][i]
            if not size:
                break
            f.seek(at)
            parts.append(_decode(header, _exactly(f, size), bh if tiled else h, bw)[:h, :w])
        if len(parts) < len(planes):
            continue
        yield c, np.stack([x[:, :, 0] for x in parts]) if header.planes > 1 else np.moveaxis(parts[0][:, :, bands], 2, 0)


def _decode(header: Header, raw: bytes, rows: int, columns: int) -> np.ndarray:
    if header.of(COMPRESSION, (1,))[0] != 1:
        raw = zlib.decompress(raw)
    samples = 1 if header.planes > 1 else header.bands
    pixels = np.frombuffer(raw, dtype=header.dtype, count=rows * columns * samples).reshape(rows, columns, samples)
    if header.of(PREDICTOR, (1,))[0] == 2:
        pixels = np.cumsum(pixels, axis=1, dtype=header.dtype)
    return pixels


def directory(size: tuple[int, int], edge: int, dtype: np.dtype, bands: int, counts: list[int], affine: tuple, crs: int | None, description: dict, deflate: bool) -> bytes:
    """All that stands before the blocks of a file with tiles in planes, whose blocks of ``counts`` bytes follow it in order; a block of no bytes is left out."""
    a, b, c, d, e, f = affine
    geo = [1, 1, 0, 3, MODEL, 0, 1, 2 if crs == 4326 else 1, RASTER, 0, 1, 1, GEOGRAPHIC if crs == 4326 else PROJECTED, 0, 1, crs or 0]
    fields: dict[int, tuple[int, list | bytes]] = {
        WIDTH: (4, [size[1]]), HEIGHT: (4, [size[0]]), BITS: (3, [8 * dtype.itemsize] * bands), COMPRESSION: (3, [8 if deflate else 1]), PHOTOMETRIC: (3, [1]),
        DESCRIPTION: (2, json.dumps(description).encode() + b"\0"), SAMPLES: (3, [bands]), PLANAR: (3, [2]), TILE_WIDTH: (4, [edge]), TILE_HEIGHT: (4, [edge]),
        SAMPLE_FORMAT: (3, [{v: k for k, v in KINDS.items()}[dtype.kind]] * bands),
        TRANSFORMATION: (12, [a, b, 0.0, c, d, e, 0.0, f, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0]),
        TILE_OFFSETS: (16, [0] * len(counts)), TILE_COUNTS: (16, counts),
    }
    if crs is not None:
        fields[GEO_KEYS] = (3, geo)
    pack = lambda kind, v: v if isinstance(v, bytes) else struct.pack(f"<{len(v)}{TYPES[kind]}", *v)
    start = 16 + 8 + 20 * len(fields) + 8
    outside = {tag: len(pack(kind, v)) for tag, (kind, v) in fields.items()}
    first = start + sum(n + -n % 8 for n in outside.values() if n > 8)
    at, offsets = first, []
    for n in counts:
        offsets.append(at if n else 0)
        at += n
    fields[TILE_OFFSETS] = (16, offsets)
    entries, tail = b"", b""
    for tag in sorted(fields):
        kind, v = fields[tag]
        raw = pack(kind, v)
        entries += struct.pack("<HHQ", tag, kind, len(v))
        if len(raw) <= 8:
            entries += raw.ljust(8, b"\0")
        else:
            entries += struct.pack("<Q", start + len(tail))
            tail += raw + b"\0" * (-len(raw) % 8)
    return b"II" + struct.pack("<HHHQQ", 43, 8, 0, 16, len(fields)) + entries + struct.pack("<Q", 0) + tail
