"""Raster files as a Spark data source and sink: tables of blocks (``BLOCK_SCHEMA`` and ``path``) in TIFF files.

``spark.read.format("raster").load(folder)`` after ``register(spark)``, or
``read_rasters`` and ``write_rasters``. Reading makes a partition of each run of
block rows; filters on raster, block and path are applied before any block is
read, and of a file only the header and the bytes of the wanted blocks are.

A written folder holds files of one raster (or of so many rows of one) each, and
manifests that name the files which count. Tasks write into a folder of their
job; what they wrote can be seen when the job's commit has written its manifest,
in one step, and not before. An attempt that failed or ran twice leaves nothing behind.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from rastra.functions.algebra import BANDS
from rastra.sources import tiff
from rastra.sources.manifests import BLOCK_SCHEMA, pixels_to_blocks

_AFFINE = pa.struct([(n, pa.float64()) for n in "abcdef"])
_INTS = ("block_row", "block_col", "row_off", "col_off", "h", "w")
_BLOCKS = pa.schema([("raster_id", pa.int64()), *[(n, pa.int32()) for n in _INTS], ("bands", pa.list_(pa.list_(pa.float32()))), ("affine", _AFFINE), ("crs", pa.int32()), ("path", pa.string())])
_MANIFEST = "_manifest-"
_EVERY = (-(1 << 62), 1 << 62)


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def _latest(fs: pafs.FileSystem, folder: str) -> tuple[int, dict[str, str]] | None:
    """Number and files, by raster and row, of a folder's last manifest."""
    found = [i.path for i in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)) if i.base_name.startswith(_MANIFEST) and i.base_name.endswith(".json")]
    if not found:
        return None
    last = max(found)
    with fs.open_input_file(last) as f:
        return int(last.rsplit(_MANIFEST, 1)[1].split(".")[0]), json.loads(f.read())


def raster_paths(path: str) -> list[str]:
    """The files of a folder: those of its last manifest, or all TIFF files below it if it has none; a file is itself. A missing path is an error."""
    fs, name = _store(path)
    info = fs.get_file_info(name)
    if info.type == pafs.FileType.File:
        return [path]
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    root = path.removesuffix(name)
    latest = _latest(fs, name)
    if latest:
        return sorted(f"{root}{name.rstrip('/')}/{f}" for f in latest[1].values())
    files = fs.get_file_info(pafs.FileSelector(name, recursive=True))
    return sorted(root + i.path for i in files if i.type == pafs.FileType.File and i.base_name.lower().endswith((".tif", ".tiff")))


def raster_number(path: str, header: tiff.Header) -> int:
    """A file's raster: what its description says, else the whole number that its name is, else a hash of its name."""
    if "raster_id" in header.description:
        return int(header.description["raster_id"])
    stem = path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
    return int(stem) if stem.isdecimal() else xxhash.xxh64_intdigest(stem.encode()) >> 2


@dataclass
class Limits:
    """What pushed filters leave: ranges and sets of a column's values."""

    ranges: dict[str, tuple[int, int]] = field(default_factory=dict)
    sets: dict[str, set] = field(default_factory=dict)

    def take(self, f: ds.Filter) -> bool:
        """Whether a filter is one that is applied here."""
        name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else ""
        if name not in ("raster_id", "path", *_INTS[:4]):
            return False
        if isinstance(f, ds.IsNotNull):
            return True  # none of them is ever null
        value = getattr(f, "value", None)
        if isinstance(f, ds.In) or isinstance(f, ds.EqualTo) and name == "path":
            wanted = set(value) if isinstance(f, ds.In) else {value}
            self.sets[name] = self.sets.get(name, wanted) & wanted
            return True
        if name == "path" or not isinstance(value, int):
            return False
        low, high = self.ranges.get(name, _EVERY)
        for kind, bounds in ((ds.EqualTo, (value, value)), (ds.GreaterThan, (value + 1, high)), (ds.GreaterThanOrEqual, (value, high)), (ds.LessThan, (low, value - 1)), (ds.LessThanOrEqual, (low, value))):
            if isinstance(f, kind):
                self.ranges[name] = max(low, bounds[0]), min(high, bounds[1])
                return True
        return False

    def allow(self, name: str, value) -> bool:
        low, high = self.ranges.get(name, _EVERY)
        return (name not in self.sets or value in self.sets[name]) and (name == "path" or low <= value <= high)

    def blocks(self, block: str, offset: str, n: int, edge: int, shift: int) -> range:
        """The run of block numbers of a file that limits on blocks and on their first pixel leave; ``shift`` is the file's first row."""
        low, high = self.ranges.get(block, _EVERY)
        first, last = self.ranges.get(offset, _EVERY)
        base = shift // edge
        return range(max(0, low - base, -(-(first - shift) // edge)), min(n - 1, high - base, (last - shift) // edge) + 1)


@dataclass
class Run(ds.InputPartition):
    path: str
    first: int
    last: int

    def __init__(self, path: str, first: int, last: int):
        self.path, self.first, self.last = path, first, last


class RasterReader(ds.DataSourceReader):
    def __init__(self, options: dict):
        self.path = options.get("path", "")
        self.bands = [int(b) for b in options["bands"].split(",")] if options.get("bands") else None
        self.run_bytes = int(options.get("partitionbytes", 64 << 20))
        self.skip = options.get("mode", "FAILFAST").upper() != "FAILFAST"
        self.limits = Limits()

    def pushFilters(self, filters):
        for f in filters:
            if not self.limits.take(f):
                yield f

    def _wanted(self, path: str, header: tiff.Header) -> tuple[range, range, int]:
        """Block rows and columns that are left of a file, and its first row."""
        shift = int(header.description.get("row_off", 0))
        (bh, bw), (down, across) = header.block, header.grid
        if not self.limits.allow("path", path) or not self.limits.allow("raster_id", raster_number(path, header)):
            return range(0), range(0), shift
        return self.limits.blocks("block_row", "row_off", down, bh, shift), self.limits.blocks("block_col", "col_off", across, bw, 0), shift

    def _open(self, path: str):
        fs, name = _store(path)
        return fs.open_input_file(name)

    def partitions(self) -> list[Run]:
        """Runs of block rows of about ``partitionBytes``. Of each file the header is read, some at a time; the blocks' places are not."""

        def runs(path: str) -> list[Run]:
            try:
                with self._open(path) as f:
                    header = tiff.read_header(f)
            except (OSError, ValueError):
                if self.skip:
                    return []
                raise
            rows, columns, _ = self._wanted(path, header)
            bands = len(self.bands) if self.bands else header.bands
            step = max(1, self.run_bytes // max(1, 4 * bands * header.block[0] * header.block[1] * max(1, len(columns))))
            return [Run(path, at, min(at + step, rows.stop)) for at in range(rows.start, rows.stop, step)] if len(columns) else []

        paths = [p for p in raster_paths(self.path) if self.limits.allow("path", p)]
        with ThreadPoolExecutor(16) as pool:
            return [r for found in pool.map(runs, paths) for r in found] or [Run("", 0, 0)]

    def read(self, partition: Run) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        with self._open(partition.path) as f:
            header = tiff.read_header(f)
            _, columns, shift = self._wanted(partition.path, header)
            (bh, bw), number = header.block, raster_number(partition.path, header)
            bands = self.bands or list(range(header.bands))
            a, b, c, d, e, y = header.affine
            affine = dict(zip("abcdef", (a, b, c - b * shift, d, e, y - e * shift), strict=True))
            for r in range(partition.first, partition.last):
                for k, pixels in tiff.read_block_row(f, header, r, columns, bands):
                    row_off, col_off = shift + r * bh, k * bw
                    if not all(self.limits.allow(n, v) for n, v in zip(_INTS, (row_off // bh, k, row_off, col_off), strict=False)):
                        continue
                    values = [x.ravel().astype(np.float32) for x in pixels]
                    one = [[number], [row_off // bh], [k], [row_off], [col_off], [pixels.shape[1]], [pixels.shape[2]], [values], [affine], [header.crs], [partition.path]]
                    yield pa.RecordBatch.from_arrays([pa.array(v, type=t.type) for v, t in zip(one, _BLOCKS, strict=True)], schema=_BLOCKS)


@dataclass
class Written(ds.WriterCommitMessage):
    files: dict[str, str]  # by raster and first row, below the folder


class _Open:
    """A file in the making: compressed blocks in the order in which they come, and where each lies."""

    def __init__(self, fs: pafs.FileSystem, name: str, first: dict):
        self.fs, self.name, self.first = fs, name, first
        self.places: dict[tuple[int, int, int], tuple[int, int]] = {}
        self.at, self.height, self.width = 0, 0, 0
        self.out = fs.open_output_stream(f"{name}.blocks")

    def add(self, plane: int, row: int, col: int, raw: bytes) -> None:
        self.places[plane, row, col] = (self.at, len(raw))
        self.out.write(raw)
        self.at += len(raw)

    def close(self, edge: int, dtype: np.dtype, deflate: bool) -> None:
        """Writes the directory and after it the blocks, in the order of the directory."""
        self.out.close()
        row_off, n = self.first["row_off"], self.first["n"]
        down, across = -(-self.height // edge), -(-self.width // edge)
        keys = [(p, r, c) for p in range(n) for r in range(down) for c in range(across)]
        places = [self.places.get(k, (0, 0)) for k in keys]
        a, b, c, d, e, f = self.first["affine"]
        moved = (a, b, c + b * row_off, d, e, f + e * row_off)
        about = {"raster_id": self.first["raster_id"], "row_off": row_off}
        with self.fs.open_output_stream(self.name) as out, self.fs.open_input_file(f"{self.name}.blocks") as blocks:
            out.write(tiff.directory((self.height, self.width), edge, dtype, n, [size for _, size in places], moved, self.first["crs"], about, deflate))
            for at, size in places:
                if size:
                    blocks.seek(at)
                    out.write(blocks.read(size))
        self.fs.delete_file(f"{self.name}.blocks")


class RasterWriter(ds.DataSourceArrowWriter):
    """Blocks of a raster's strip must come to one task, one after the other: ``write_rasters`` deals them so."""

    def __init__(self, options: dict, overwrite: bool):
        self.path = options["path"].rstrip("/")
        self.edge, self.strip = int(options.get("edge", 256)), int(options.get("striprows", 1 << 14))
        self.dtype, self.deflate = np.dtype("<" + options.get("dtype", "f4")), options.get("compression", "deflate") == "deflate"
        if self.edge % 16 or self.strip % self.edge:
            raise ValueError("a block's edge must be a multiple of 16, and a strip's rows one of the edge")
        self.overwrite, self.job = overwrite, f"data-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = _store(self.path)
        own = f"{self.job}/{uuid.uuid4().hex}"
        files: dict[str, str] = {}
        key, file = None, None
        for batch in iterator:
            for r in range(batch.num_rows):
                row = batch.slice(r, 1)
                one = {n: row[n][0].as_py() for n in ("raster_id", *_INTS, "affine", "crs")}
                strip = one["row_off"] // self.strip * self.strip
                if key != (one["raster_id"], strip):
                    if file:
                        file.close(self.edge, self.dtype, self.deflate)
                    key = (one["raster_id"], strip)
                    name = f"{key[0]}-{strip}"
                    if name in files:
                        raise ValueError("blocks of a raster must come one after the other; write_rasters sorts them")
                    if not files:
                        fs.create_dir(f"{folder}/{own}", recursive=True)
                    files[name] = f"{own}/{name}.tif"
                    affine = tuple(one["affine"][n] for n in "abcdef") if one["affine"] else (1.0, 0.0, 0.0, 0.0, 1.0, 0.0)
                    file = _Open(fs, f"{folder}/{files[name]}", {"raster_id": key[0], "row_off": strip, "n": len(row["bands"][0]), "affine": affine, "crs": one["crs"]})
                if one["row_off"] % self.edge or one["col_off"] % self.edge or max(one["h"], one["w"]) > self.edge:
                    raise ValueError(f"a block must lie within a cell of {self.edge} pixels")
                file.height, file.width = max(file.height, one["row_off"] - strip + one["h"]), max(file.width, one["col_off"] + one["w"])
                for plane, band in enumerate(row["bands"][0]):
                    pixels = np.zeros((self.edge, self.edge), dtype=self.dtype)
                    values = band.values.to_numpy(zero_copy_only=False)
                    pixels[: one["h"], : one["w"]] = values.reshape(one["h"], one["w"])
                    raw = pixels.tobytes()
                    file.add(plane, (one["row_off"] - strip) // self.edge, one["col_off"] // self.edge, zlib.compress(raw, 6) if self.deflate else raw)
        if file:
            file.close(self.edge, self.dtype, self.deflate)
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        """Writes the manifest, then deletes what no manifest names any more."""
        fs, folder = _store(self.path)
        files: dict[str, str] = {}
        for m in messages:
            for name, file in (m.files if m else {}).items():
                if name in files:
                    raise ValueError(f"two tasks wrote raster and row {name}")
                files[name] = file
        fs.create_dir(folder, recursive=True)
        number, before = _latest(fs, folder) or (0, {})
        named = files if self.overwrite else before | files
        draft = f"{folder}/_draft-{self.job}"
        with fs.open_output_stream(draft) as f:
            f.write(json.dumps(named, sort_keys=True).encode())
        fs.move(draft, f"{folder}/{_MANIFEST}{number + 1:012d}.json")
        kept = {f"{folder}/{x}" for x in named.values()}
        jobs = {self.job, *(x.split("/")[0] for x in before.values())}
        for job in jobs:
            for i in fs.get_file_info(pafs.FileSelector(f"{folder}/{job}", recursive=True, allow_not_found=True)):
                if i.type == pafs.FileType.File and i.path not in kept:
                    fs.delete_file(i.path)

    def abort(self, messages: list[Written | None]) -> None:
        fs, folder = _store(self.path)
        if fs.get_file_info(f"{folder}/{self.job}").type != pafs.FileType.NotFound:
            fs.delete_dir(f"{folder}/{self.job}")


class RasterSource(ds.DataSource):
    """Options: ``path``; ``bands`` (numbers from 0, all without it), ``partitionBytes``, ``mode`` (``PERMISSIVE`` passes over broken files); to write ``edge``, ``stripRows``, ``dtype``, ``compression``."""

    @classmethod
    def name(cls) -> str:
        return "raster"

    def schema(self) -> str:
        return f"{BLOCK_SCHEMA}, path string"

    def reader(self, schema) -> RasterReader:
        return RasterReader({k.lower(): v for k, v in self.options.items()})

    def writer(self, schema, overwrite: bool) -> RasterWriter:
        return RasterWriter({k.lower(): v for k, v in self.options.items()}, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RasterSource)


def read_rasters(spark: SparkSession, path: str, **options) -> DataFrame:
    """Blocks of a raster file or of all files of a folder, of ``BLOCK_SCHEMA`` with the file's ``path``; values as 32-bit floats.

    A file's blocks are its tiles, or its strips of rows. Blocks that a sparse
    file leaves out have no rows. A broken or unreadable file is an error, unless
    ``mode="PERMISSIVE"``; ``raster_files`` says what is wrong with which. A folder without files gives no rows.
    """
    register(spark)
    return spark.read.format("raster").options(**options).load(path)


def write_rasters(blocks: DataFrame, path: str, mode: str = "overwrite", edge: int = 256, strip_rows: int = 1 << 14, **options) -> None:
    """Blocks of ``BLOCK_SCHEMA`` (each in one cell of ``edge`` pixels) as tiled files: one a raster, or one for each ``strip_rows`` of its rows.

    A raster's strip is one task's work, block by block. ``append`` replaces files of the same raster and strip and keeps all others.
    An empty table writes a folder without files. Two blocks at one place are an error of the caller: the later one stays.
    """
    register(blocks.sparkSession)
    strip = F.floor(F.col("row_off") / F.lit(strip_rows))
    named = [f.split()[0] for f in ("raster_id", *_INTS, "bands", "affine", "crs")]
    dealt = blocks.select(*named).withColumn("_strip", strip).repartition("raster_id", "_strip").sortWithinPartitions("raster_id", "_strip", "block_row", "block_col")
    dealt.drop("_strip").write.format("raster").mode(mode).options(edge=edge, stripRows=strip_rows, **options).save(path)


_SIZES = ("row_off", "height", "width", "block_height", "block_width", "bands", "crs")
_FILES = pa.schema([("path", pa.string()), ("raster_id", pa.int64()), *[(n, pa.int32()) for n in _SIZES], ("dtype", pa.string()), ("affine", _AFFINE), ("error", pa.string())])
_FILES_DDL = f"path string, raster_id bigint, {', '.join(f'{n} int' for n in _SIZES)}, dtype string, affine struct<a: double, b: double, c: double, d: double, e: double, f: double>, error string"


def raster_files(spark: SparkSession, path: str) -> DataFrame:
    """What the header of each file says, a row a file; ``error`` where a file can't be read. Headers are read in tasks."""

    def heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for p in batch["path"].to_pylist():
                row = {"path": p}
                try:
                    fs, name = _store(p)
                    with fs.open_input_file(name) as f:
                        h = tiff.read_header(f)
                    row |= {"raster_id": raster_number(p, h), "row_off": int(h.description.get("row_off", 0)), "height": h.size[0], "width": h.size[1], "block_height": h.block[0], "block_width": h.block[1]}
                    row |= {"bands": h.bands, "dtype": h.dtype.name, "affine": dict(zip("abcdef", h.affine, strict=True)), "crs": h.crs}
                except (OSError, ValueError) as e:
                    row["error"] = str(e) or type(e).__name__
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema=_FILES)

    paths = raster_paths(path)
    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, min(len(paths), 1000)))
    return listed.mapInArrow(heads, _FILES_DDL)


def filled(pixels: DataFrame, edge: int, bands: tuple[str, ...] = BANDS) -> DataFrame:
    """``raster_id, row, col`` and the bands, with NaN for pixels that are missing between a block's corner and its last row and column; only blocks with some missing are looked through."""
    keys = ["raster_id", "row", "col"]
    block = [F.floor(F.col(c) / edge).cast("int").alias(f"_{c}") for c in ("row", "col")]
    sized = pixels.groupBy("raster_id", *block).agg(F.max("row").alias("r1"), F.max("col").alias("c1"), F.count("*").alias("n"))
    short = sized.where(F.col("n") < (F.col("r1") - F.col("_row") * edge + 1) * (F.col("c1") - F.col("_col") * edge + 1))
    rows = short.withColumn("row", F.explode(F.sequence((F.col("_row") * edge).cast("int"), F.col("r1").cast("int"))))
    cells = rows.withColumn("col", F.explode(F.sequence((F.col("_col") * edge).cast("int"), F.col("c1").cast("int"))))
    missing = cells.select(*keys).join(pixels.select(*keys), keys, "left_anti")
    return pixels.select(*keys, *bands).unionByName(missing.select(*keys, *[F.lit(float("nan")).alias(b) for b in bands]))


def write_pixels(pixels: DataFrame, path: str, edge: int = 256, affine: tuple = (1.0, 0.0, 0.0, 0.0, -1.0, 0.0), crs: int | None = None, bands: tuple[str, ...] = BANDS, mode: str = "overwrite", **options) -> None:
    """A pixel table (a stacked scene, composite or probabilities) as raster files; pixels missing inside a block are written as NaN."""
    write_rasters(pixels_to_blocks(filled(pixels, edge, bands), edge, bands, affine, crs), path, mode, edge, **options)
