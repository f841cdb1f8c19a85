"""Raster files: headers and blocks against files written here byte by byte, the sink's commits, and what a window reads."""

import glob
import io
import json
import os
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rastra import sinks
from rastra.functions.algebra import BANDS
from rastra.operators import grid
from rastra.sources import manifests, rasters, tiff


def plain_tiff(pixels, order="<", block=None, deflate=False, predictor=1, planes=False, geo=(), big=False):
    """A TIFF of (row, column, band) pixels, in strips or tiles of ``block`` (rows, columns), its directory at the end."""
    height, width, bands = pixels.shape
    tiled = block is not None and len(block) == 2
    bh, bw = block if tiled else (block[0] if block else height, width)
    out, offsets, counts = io.BytesIO(), [], []
    out.write(b"\0" * 16)
    for part in np.moveaxis(pixels, 2, 0)[..., None] if planes else [pixels]:
        for r in range(0, height, bh):
            for c in range(0, width, bw):
                x = part[r : r + bh, c : c + bw]
                if tiled:
                    x = np.pad(x, ((0, bh - x.shape[0]), (0, bw - x.shape[1]), (0, 0)))
                if predictor == 2:
                    x = np.concatenate([x[:, :1], np.diff(x, axis=1)], axis=1)
                raw = x.astype(pixels.dtype.newbyteorder(order)).tobytes()
                raw = zlib.compress(raw) if deflate else raw
                offsets.append(out.tell())
                counts.append(len(raw))
                out.write(raw)
    kind = {"u": 1, "i": 2, "f": 3}[pixels.dtype.kind]
    place, size = (324, 325) if tiled else (273, 279)
    fields = [(256, "I", [width]), (257, "I", [height]), (258, "H", [8 * pixels.dtype.itemsize] * bands), (259, "H", [8 if deflate else 1]), (277, "H", [bands]), (284, "H", [2 if planes else 1]), (317, "H", [predictor]), (339, "H", [kind] * bands)]
    fields += [(322, "H", [bw]), (323, "H", [bh])] if tiled else [(278, "I", [bh])]
    fields += [(place, "I", offsets), (size, "I", counts), *geo]
    types = {"B": 1, "s": 2, "H": 3, "I": 4, "d": 12}
    entries = []
    for tag, code, values in sorted(fields):
        raw = struct.pack(f"{order}{len(values)}{code}", *values)
        if len(raw) > (8 if big else 4):
            at = out.tell()
            out.write(raw)
            raw = struct.pack(order + ("Q" if big else "I"), at)
        entries.append(struct.pack(order + ("HHQ" if big else "HHI"), tag, types[code], len(values)) + raw.ljust(8 if big else 4, b"\0"))
    start = out.tell()
    out.write(struct.pack(order + ("Q" if big else "H"), len(entries)) + b"".join(entries) + b"\0" * 8)
    head = (b"II" if order == "<" else b"MM") + (struct.pack(order + "HHHQ", 43, 8, 0, start) if big else struct.pack(order + "HI", 42, start))
    return head + out.getvalue()[len(head) :]


def cube(blocks, number, height, width, bands):
    got = np.full((height, width, bands), np.nan)
    for r in blocks.where(F.col("raster_id") == number).collect():
        for k, band in enumerate(r["bands"]):
            got[r["row_off"] : r["row_off"] + r["h"], r["col_off"] : r["col_off"] + r["w"], k] = np.reshape(band, (r["h"], r["w"]))
    return got


KINDS = [
    {}, {"order": ">", "block": (7,)}, {"block": (16, 32), "deflate": True}, {"order": ">", "block": (16, 16), "deflate": True, "predictor": 2},
    {"block": (5,), "planes": True, "deflate": True}, {"block": (16, 16), "planes": True, "big": True}, {"order": ">", "block": (3,), "big": True, "deflate": True},
]


@pytest.mark.parametrize("dtype", ["uint8", "int16", "float32"])
@pytest.mark.parametrize("kind", KINDS)
def test_files_of_all_kinds(tmp_path, dtype, kind):
    if kind.get("predictor") == 2 and dtype == "float32":
        pytest.skip("the horizontal predictor is for whole numbers")
    pixels = np.random.default_rng(1).integers(0, 200, (37, 50, 3)).astype(dtype)
    (tmp_path / "7.tif").write_bytes(plain_tiff(pixels, **kind))
    reader = rasters.RasterReader({"path": str(tmp_path), "partitionbytes": "2000"})
    got = np.full(pixels.shape, np.nan)
    runs = reader.partitions()
    for run in runs:
        for b in reader.read(run):
            r = b.to_pylist()[0]
            assert r["raster_id"] == 7
            got[r["row_off"] : r["row_off"] + r["h"], r["col_off"] : r["col_off"] + r["w"]] = np.moveaxis(np.reshape(r["bands"], (3, r["h"], r["w"])), 0, 2)
    assert (got == pixels).all()
    assert len(runs) > 1 or not kind


def test_a_window_reads_only_its_blocks(spark, tmp_path):
    pixels = np.arange(64 * 64 * 2, dtype=np.float32).reshape(64, 64, 2)
    raw = bytearray(plain_tiff(pixels, block=(16, 16), deflate=True, planes=True))
    header = tiff.read_header(io.BytesIO(raw))
    places = [tiff._values(io.BytesIO(raw), header, header.fields[t], 0, 32) for t in (tiff.TILE_OFFSETS, tiff.TILE_COUNTS)]
    for i, (at, n) in enumerate(zip(*places, strict=True)):
        if i != 16 + 1 * 4 + 2:  # all but one block of the second band are spoilt
            raw[at : at + n] = b"\xff" * n
    (tmp_path / "3.tif").write_bytes(raw)
    (tmp_path / "4.tif").write_bytes(b"no raster")
    blocks = rasters.read_rasters(spark, str(tmp_path), bands="1", mode="PERMISSIVE")
    window = manifests.blocks_to_pixels(blocks.where("raster_id = 3 AND block_row = 1 AND block_col BETWEEN 2 AND 2"), ("nir",))
    got = {(r["row"], r["col"]): r["nir"] for r in window.collect()}
    assert got == {(r, c): float(pixels[r, c, 1]) for r in range(16, 32) for c in range(32, 48)}
    with pytest.raises(Exception, match="zlib|incorrect header"):
        blocks.where("raster_id = 3").collect()
    for condition in ("raster_id = 4", "raster_id IN (9, 10)", "block_row > 3", "path = 'x'", "row_off < 0", "col_off >= 64"):
        assert blocks.where(condition).collect() == []


@pytest.mark.parametrize("condition", ["row_off >= 17 AND row_off < 48", "block_row = 2 OR block_col = 0", "block_col <= 1 AND row_off = 16", "col_off IN (0, 32)", "h < 16", "raster_id = 5 AND block_row <> 1", "block_row = NULL", "path LIKE '%5.tif'"])
def test_filters_give_what_they_would_after_the_scan(spark, tmp_path, condition):
    pixels = np.arange(50 * 40, dtype=np.uint16).reshape(50, 40, 1)
    for n in (5, 6):
        (tmp_path / f"{n}.tif").write_bytes(plain_tiff(pixels, block=(16, 16)))
    blocks = rasters.read_rasters(spark, str(tmp_path)).select("raster_id", "block_row", "block_col", "row_off", "col_off", "h", "path")
    whole = spark.createDataFrame(blocks.collect(), blocks.schema)
    assert whole.count() == 2 * 4 * 3
    assert sorted(blocks.where(condition).collect()) == sorted(whole.where(condition).collect())


def test_headers_and_faults(spark, tmp_path):
    geo = [(33550, "d", [10.0, 20.0, 0.0]), (33922, "d", [0.0, 0.0, 0.0, 500.0, 9000.0, 0.0]), (34735, "H", [1, 1, 0, 1, 3072, 0, 1, 32632])]
    good = plain_tiff(np.zeros((8, 9, 2), np.int16), geo=geo)
    (tmp_path / "scene.tif").write_bytes(good)
    (tmp_path / "cut.tif").write_bytes(good[:60])
    (tmp_path / "text.tiff").write_bytes(b"")
    (tmp_path / "lzw.tif").write_bytes(good.replace(struct.pack("<HHIH", 259, 3, 1, 1), struct.pack("<HHIH", 259, 3, 1, 5)))
    (tmp_path / "other.txt").write_text("x")
    found = {os.path.basename(r["path"]): r for r in rasters.raster_files(spark, str(tmp_path)).collect()}
    r = found.pop("scene.tif")
    assert (r["height"], r["width"], r["bands"], r["dtype"], r["crs"], r["error"]) == (8, 9, 2, "int16", 32632, None)
    assert tuple(r["affine"]) == (10.0, 0.0, 500.0, 0.0, -20.0, 9000.0)
    assert {k: v["height"] for k, v in found.items()} == {"cut.tif": None, "text.tiff": None, "lzw.tif": None}
    assert all(v["error"] for v in found.values())
    assert rasters.read_rasters(spark, str(tmp_path), mode="PERMISSIVE").count() == 1
    with pytest.raises(Exception, match="not a TIFF|too early|deflate"):
        rasters.read_rasters(spark, str(tmp_path)).count()
    with pytest.raises(Exception, match="nowhere"):
        rasters.read_rasters(spark, str(tmp_path / "nowhere")).count()
    (tmp_path / "none").mkdir()
    assert rasters.read_rasters(spark, str(tmp_path / "none")).count() == 0 and rasters.raster_files(spark, str(tmp_path / "none")).count() == 0


AFFINE = (10.0, 1.0, 500.0, 2.0, -20.0, 9000.0)


@pytest.mark.parametrize(("dtype", "compression", "strip"), [("f4", "deflate", 64), ("f4", "none", 16), ("u2", "deflate", 32)])
def test_round_trip_with_affine_and_crs(spark, tmp_path, dtype, compression, strip):
    path = str(tmp_path / "out")
    pixels = manifests.synthetic_raster(spark, 45, 70, raster_id=3).unionByName(manifests.synthetic_raster(spark, 20, 33, seed=1, raster_id=4))
    rasters.write_pixels(pixels, path, edge=16, affine=AFFINE, crs=32632, striprows=strip, dtype=dtype, compression=compression)
    blocks = rasters.read_rasters(spark, path)
    assert sorted(manifests.blocks_to_pixels(blocks).select(pixels.columns).collect()) == sorted(pixels.collect())
    assert {(tuple(r["affine"]), r["crs"]) for r in blocks.collect()} == {(AFFINE, 32632)}
    files = rasters.raster_files(spark, path).collect()
    assert len(files) == -(-45 // strip) + -(-20 // strip)
    for r in files:  # each file says where it lies by itself
        assert tuple(r["affine"])[2::3] == (500.0 + r["row_off"], 9000.0 - 20 * r["row_off"])
    assert manifests.read_window(blocks, 3, 14, 30, 5, 4, 16).count() == 20


def test_a_write_is_seen_whole_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "out")
    first, second = (manifests.pixels_to_blocks(manifests.synthetic_raster(spark, 32, 32, seed=n, raster_id=n), 16) for n in (1, 2))
    rasters.write_rasters(first, path, edge=16)
    before = sorted(glob.glob(f"{path}/**", recursive=True))
    broken = second.withColumn("bands", F.when(F.col("block_row") == 1, F.raise_error(F.lit("lost executor"))).otherwise(F.col("bands")))
    for mode in ("append", "overwrite"):
        with pytest.raises(Exception, match="lost executor"):
            rasters.write_rasters(broken, path, mode, edge=16)
        assert sorted(glob.glob(f"{path}/**", recursive=True)) == before
    rasters.write_rasters(second, path, "append", edge=16)
    assert {r[0] for r in rasters.read_rasters(spark, path).select("raster_id").collect()} == {1, 2}
    rasters.write_rasters(first.withColumn("crs", F.lit(4326)), path, "append", edge=16)  # the same raster again takes the place of its file
    assert {tuple(r) for r in rasters.read_rasters(spark, path).select("raster_id", "crs").collect()} == {(1, 4326), (2, None)}
    rasters.write_rasters(second, path, "overwrite", edge=16)
    assert len(glob.glob(f"{path}/**/*.tif", recursive=True)) == 1 and not glob.glob(f"{path}/**/*.blocks", recursive=True)
    rasters.write_rasters(first.limit(0), path, "overwrite", edge=16)
    assert rasters.read_rasters(spark, path).count() == 0


def test_attempts_that_are_not_committed_leave_nothing(tmp_path):
    import pyarrow as pa

    def batches():
        one = {"raster_id": 1, "block_row": 0, "block_col": 0, "row_off": 0, "col_off": 0, "h": 16, "w": 16, "bands": [[1.0] * 256], "affine": None, "crs": None}
        yield pa.RecordBatch.from_pylist([one], schema=pa.schema([f for f in rasters._BLOCKS if f.name != "path"]))

    def dying():
        yield from batches()
        raise RuntimeError("killed")

    writer = rasters.RasterWriter({"path": str(tmp_path), "edge": "16"}, False)
    with pytest.raises(RuntimeError):
        writer.write(dying())
    twice, kept = writer.write(batches()), writer.write(batches())
    assert len(glob.glob(f"{tmp_path}/**/*.tif", recursive=True)) == 2
    writer.commit([kept, None])
    assert [os.path.relpath(f, tmp_path) for f in glob.glob(f"{tmp_path}/**/*.*", recursive=True) if not f.endswith(".json")] == list(kept.files.values())
    again = rasters.RasterWriter({"path": str(tmp_path), "edge": "16"}, False)
    with pytest.raises(ValueError, match="two tasks"):
        again.commit([again.write(batches()), again.write(batches())])
    again.abort([])
    assert rasters.raster_paths(str(tmp_path)) == [f"{tmp_path}/{f}" for f in kept.files.values()] and twice.files != kept.files
    assert json.loads(open(sorted(glob.glob(f"{tmp_path}/_manifest*"))[-1]).read()) == kept.files


@pytest.mark.parametrize(("options", "says"), [({"edge": "20"}, "multiple of 16"), ({"edge": "16", "striprows": "40"}, "multiple of 16")])
def test_edges_of_tiles(options, says):
    with pytest.raises(ValueError, match=says):
        rasters.RasterWriter({"path": "x", **options}, True)


def test_missing_pixels_are_written_as_nan(spark, tmp_path):
    whole = manifests.synthetic_raster(spark, 20, 20)
    some = whole.where("NOT (row = 3 AND col = 3) AND col > 0 AND row > 1")
    rasters.write_pixels(some, str(tmp_path / "x"), edge=16)
    back = {(r["row"], r["col"]): r["nir"] for r in manifests.blocks_to_pixels(rasters.read_rasters(spark, str(tmp_path / "x"))).collect()}
    kept = {(r["row"], r["col"]): r["nir"] for r in some.collect()}
    assert len(back) == 400 and {k: v for k, v in back.items() if v == v} == kept


def test_chips_of_one_raster(spark, tmp_path):
    pixels = manifests.synthetic_raster(spark, 40, 40, raster_id=2)
    chips = grid.tile_windows(manifests.raster_size(pixels), 16, 4)
    named = sinks.write_chips(pixels, chips.where("row_off > 0"), str(tmp_path / "c"), 16, 4, 40, 40, (10.0, 0.0, 7.0, 0.0, -10.0, 9.0), 32632)
    blocks = {r["raster_id"]: r for r in rasters.read_rasters(spark, str(tmp_path / "c")).collect()}
    source = {(r["row"], r["col"]): [r[b] for b in BANDS] for r in pixels.collect()}
    assert {r["chip"] for r in named.collect()} == set(blocks) and len(blocks) == 6
    for r in named.collect():
        b = blocks[r["chip"]]
        assert tuple(b["affine"]) == (10.0, 0.0, 7.0 + 10 * r["col_off"], 0.0, -10.0, 9.0 - 10 * r["row_off"])
        assert [x[5 * 16 + 3] for x in b["bands"]] == source[r["row_off"] + 5, r["col_off"] + 3]


def test_flow_from_files_to_files(spark, tmp_path):
    """A composite in files is scored, and the probabilities are files with the same grid."""
    from rastra.operators import inference

    rasters.write_pixels(manifests.synthetic_raster(spark, 32, 32), str(tmp_path / "composite"), edge=16, affine=AFFINE, crs=32632)
    pixels = manifests.blocks_to_pixels(rasters.read_rasters(spark, str(tmp_path / "composite")))
    prob = inference.sliding_window(pixels, inference.BASELINE, 16, 4, 32, 32)
    rasters.write_pixels(prob, str(tmp_path / "prob"), edge=16, affine=AFFINE, crs=32632, bands=("prob",))
    back = manifests.blocks_to_pixels(rasters.read_rasters(spark, str(tmp_path / "prob")), ("prob",))
    met = back.withColumnRenamed("prob", "stored").join(prob, ["raster_id", "row", "col"])
    assert met.count() == 1024 and met.where("abs(stored - prob) > 1e-6").count() == 0


def test_an_area_without_detections_loses_its_old_ones(spark, tmp_path):
    path = str(tmp_path / "d")
    found = spark.createDataFrame([(1, 0.5, "a"), (2, 0.6, "b b/c"), (3, None, None)], "id long, score double, aoi string")
    areas = spark.createDataFrame([("a",), ("b b/c",), (None,)], "aoi string")
    sinks.store_detections(found, path, "m/1", areas=areas)
    sinks.store_detections(found.where("id = 2"), path, "m2", areas=areas)
    sinks.store_detections(found.where("id = 1"), path, "m/1", areas=areas)
    assert sorted(map(tuple, spark.read.parquet(path).select("id", "model_version").collect())) == [(1, "m/1"), (2, "m2")]
    sinks.store_detections(found.limit(0), path, "m2", areas=areas.where("aoi = 'a'"))  # not of the run: b
    assert spark.read.parquet(path).count() == 2
    sinks.store_detections(found.drop("aoi").limit(0), path, "m/1", "a")
    assert [r["id"] for r in spark.read.parquet(path).collect()] == [2]
