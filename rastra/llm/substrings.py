"""Exact repeats of long passages across documents, by seed and extend."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastra.llm.common import WordHashes, output, pieces, slices, spread_join, texts
from rastra.storage import discard, settle

#: Odd multiplier of the rolling hashes over words, and its inverse modulo 2^64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def span_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the words of each span, from the words' own hashes."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * _powers(_BASE, len(words)), dtype=np.uint64)])
    return _mix((sums[ends] - sums[starts]) * _powers(_INVERSE, len(words) + 1)[starts])


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """The hash of every run of ``n`` words."""
    at = np.arange(max(0, len(words) - n + 1))
    return span_hashes(words, at, at + n)


def anchors(words: np.ndarray, window: int, seed: int) -> np.ndarray:
    """For every window, the position of its seed: the run of ``seed`` words in it with the smallest hash.

    It depends on the window's words alone (the first of equal hashes counts),
    so equal windows have equal seeds at equal offsets.
    """
    grams = gram_hashes(words, seed)
    n, span = len(words) - window + 1, window - seed + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    out = np.empty(n, np.int64)
    for at in range(0, n, 1 << 16):
        part = np.lib.stride_tricks.sliding_window_view(grams[at : at + (1 << 16) + span - 1], span)[: n - at]
        out[at : at + len(part)] = part.argmin(axis=1) + np.arange(at, at + len(part))
    return out


class Regions:
    """The extension of each seed of a text to both sides: all windows that it stands for, one after the other.

    ``first`` and ``last`` are the windows' starts, ``seed`` is the seed's hash,
    and ``key`` one of all the region's words and of the seed's place in them.
    """

    def __init__(self, words: np.ndarray, window: int, seed: int):
        at = anchors(words, window, seed)
        self.first = np.flatnonzero(np.diff(at, prepend=-1))
        self.last = np.append(self.first[1:], len(at))[: len(self.first)] - 1
        self.seed = gram_hashes(words, seed)[at[self.first]]
        place = (at[self.first] - self.first).astype(np.uint64) << np.uint64(32) | (self.last - self.first).astype(np.uint64)
        self.key = _mix(span_hashes(words, self.first, self.last + window) + place * np.uint64(_BASE))


_REGIONS = pa.schema([(c, pa.int64()) for c in ("doc_id", "row")] + [(c, pa.int32()) for c in ("at", "n")] + [(c, pa.int64()) for c in ("seed", "key")])
_WINDOWS = pa.schema([(c, pa.int64()) for c in ("seed", "key", "lo")] + [("off", pa.int32()), ("hash", pa.int64())])


def _kind(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'int' if f.type == pa.int32() else 'long'}" for f in schema)


def _in_bulk(rows: Iterator[dict[str, np.ndarray]], schema: pa.Schema, most: int = 1 << 17) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``most`` rows from many small sets of columns."""
    held: dict[str, list] = {f.name: [] for f in schema}
    n = 0

    def batch() -> pa.RecordBatch:
        return output({c: pa.array(np.concatenate(v)) for c, v in held.items()}, schema)

    for columns in rows:
        for c, v in columns.items():
            held[c].append(v)
        n += len(columns[schema.names[0]])
        if n >= most:
            yield batch()
            held, n = {f.name: [] for f in schema}, 0
    if n:
        yield batch()


def _regions(window: int, seed: int):
    """The regions of each text, without its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()

        def each() -> Iterator[dict[str, np.ndarray]]:
            for batch in slices(batches):
                for doc, row, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts(batch.column(2)), strict=True):
                    found = Regions(memo.of(raw), window, seed)
                    n = len(found.first)
                    if n:
                        yield {
                            "doc_id": np.full(n, doc, np.int64),
                            "row": np.full(n, row, np.int64),
                            "at": found.first.astype(np.int32),
                            "n": (found.last - found.first + 1).astype(np.int32),
                            "seed": found.seed.view(np.int64),
                            "key": found.key.view(np.int64),
                        }

        yield from _in_bulk(each(), _REGIONS)

    return run


def _windows(window: int):
    """The hash of every window of the asked regions of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()

        def each() -> Iterator[dict[str, np.ndarray]]:
            for batch in slices(batches):
                for doc, packed, asked in zip(batch.column(0).to_pylist(), texts(batch.column(1)), batch.column(2), strict=True):
                    hashes = gram_hashes(memo.of(unpack(packed)), window).view(np.int64)
                    seed, key, at, n = (asked.values.field(i).to_numpy() for i in range(4))
                    off = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    yield {
                        "seed": np.repeat(seed, n),
                        "key": np.repeat(key, n),
                        "lo": np.full(len(off), doc, np.int64),
                        "off": off.astype(np.int32),
                        "hash": hashes[np.repeat(at, n) + off],
                    }

        yield from _in_bulk(each(), _WINDOWS)

    return run


def pack(text: str) -> Column:
    """Texts compressed for the way through a shuffle."""

    @F.arrow_udf("binary")
    def packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        press = zstandard.ZstdCompressor(level=3).compress
        for batch in slices(batches):
            yield pa.array([None if raw is None else press(raw) for raw in texts(batch)], pa.binary())

    return packed(text)


def unpack(packed: bytes | None) -> bytes:
    return zstandard.decompress(packed) if packed else b""


def covered(at: np.ndarray, n: np.ndarray, window: int, words: int) -> np.ndarray:
    """Which of so many words lie in one of the ``n`` windows from a start ``at``; neighbouring windows join to maximal repeats."""
    edge = np.zeros(words + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + n - 1 + window, -1)
    return np.cumsum(edge[:words]) > 0


_CUT = pa.struct(
    [
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("kept", pa.binary()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64())]))),
    ]
)


def _cut_udf(window: int):
    def cut_one(raw: bytes, repeats: pa.StructArray | None) -> dict:
        words = [w for p in pieces(raw) for w in p.split()]
        if repeats is None:
            return {"n_words": len(words), "n_removed": 0, "kept": b" ".join(words), "spans": []}
        gone = covered(repeats.field(0).to_numpy(), repeats.field(1).to_numpy(), window, len(words))
        kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
        bounds = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
        spans = [{"start": a, "words": b - a} for a, b in zip(bounds[::2].tolist(), bounds[1::2].tolist(), strict=True)]
        return {"n_words": len(words), "n_removed": int(gone.sum()), "kept": kept, "spans": spans}

    @F.arrow_udf("struct<n_words: bigint, n_removed: bigint, kept: binary, spans: array<struct<start: bigint, words: bigint>>>")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for packed, repeats in slices(batches):
            rows = zip(texts(packed), repeats, strict=True)
            yield pa.array([cut_one(unpack(raw), r.values) for raw, r in rows], type=_CUT)

    return cut.asNondeterministic()


def find_repeats(body: DataFrame, window: int, seed: int) -> DataFrame:
    """``doc_id, row, repeats``: for each row of ``doc_id, row, text`` the runs of windows that begin in a smaller id as well.

    Only narrow rows are exchanged, a row a region, but for the texts of
    the documents that hold the classes of seeds with several of them.
    """
    whole = body.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "row", "text")
    regions = settle(whole.mapInArrow(_regions(window, seed), _kind(_REGIONS)), "repeats_regions", compression="zstd")
    ends = [F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.count("*").alias("rows")]
    shared = settle(regions.groupBy("seed").agg(*ends).where("lo < hi").select("seed", "rows"), "repeats_shared")
    alive = settle(spread_join(regions, shared, ["seed"], "rows", ["doc_id", "at"]).drop("rows"), "repeats_alive", compression="zstd")
    discard(regions, shared)
    held = F.min(F.struct("doc_id", "row", "at")).alias("holder")
    classes = alive.groupBy("seed", "key").agg(held, F.first("n").alias("n"), F.count("*").alias("rows"))
    classes = settle(classes.select("seed", "key", F.col("holder.doc_id").alias("lo"), "holder.row", "holder.at", "n", "rows"), "repeats_classes")
    rivals = classes.groupBy("seed").agg(F.min("lo").alias("a"), F.max("lo").alias("b"), F.count("*").alias("classes")).where("a < b")
    rivals = settle(rivals.select("seed", "classes"), "repeats_rivals")
    asked = spread_join(classes.drop("rows"), rivals, ["seed"], "classes", ["key"])
    asked = asked.groupBy(F.col("lo").alias("holder_id"), F.col("row").alias("holder_row")).agg(F.collect_list(F.struct("seed", "key", "at", "n")).alias("asked"))
    held_text = whole.select("doc_id", "row", pack("text").alias("packed"))
    wide = held_text.join(asked, (F.col("doc_id") == F.col("holder_id")) & (F.col("row") == F.col("holder_row"))).select("doc_id", "packed", "asked")
    windows = settle(wide.mapInArrow(_windows(window), _kind(_WINDOWS)), "repeats_windows", compression="zstd")
    firsts = windows.groupBy("seed", "hash").agg(F.min("lo").alias("first"), F.max("lo").alias("last"), F.count("*").alias("rows")).where("first < last")
    firsts = settle(firsts.select("seed", "hash", "first", "rows"), "repeats_firsts")
    later = spread_join(windows, firsts, ["seed", "hash"], "rows", ["key"]).where("lo > first")
    cuts = later.groupBy("seed", "key").agg(F.collect_set("off").alias("offs"))
    decided = classes.select("seed", "key", "lo", "rows").join(cuts, ["seed", "key"], "left").where("rows > 1 OR offs IS NOT NULL")
    decided = settle(decided, "repeats_decided")
    discard(classes, rivals, windows, firsts)
    hits = spread_join(alive, decided, ["seed", "key"], "rows", ["doc_id", "at"]).where("doc_id > lo OR offs IS NOT NULL")
    whole_region = F.array(F.struct("at", "n"))
    some = F.transform("offs", lambda o: F.struct((F.col("at") + o).alias("at"), F.lit(1).alias("n")))
    spans = hits.select("doc_id", "row", F.explode(F.when(F.col("doc_id") > F.col("lo"), whole_region).otherwise(some)).alias("span"))
    # rows alike in id and text have their spans once
    found = settle(spans.groupBy("doc_id", "row").agg(F.collect_set("span").alias("repeats")), "repeats_spans", compression="zstd")
    discard(alive, decided)
    return found


def remove_repeats(docs: DataFrame, window: int = 50, seed: int = 10, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Cut every passage of ``window`` words or more that also begins in a document with a smaller id.

    Seeds are winnowed: every window of ``window`` words has one, chosen by its
    own words, and each seed is extended to both sides, over all windows that it
    stands for. Documents are joined on the seeds that several of them have.
    Equal regions of one seed are one class, held by its smallest document, and
    all other documents of a class repeat the whole region; where a seed has
    several classes, the windows of their holders are compared as well. So no
    pairs are made, and a passage in very many documents is one class. Seed and
    region, or seed and window, are compared by 64 bits each. Windows are judged
    on the input.

    Returns ``doc_id, n_words, n_removed, kept`` (the words left, joined by one
    space, as bytes) and ``spans`` (the maximal repeats that went: first word
    and number of words). Null texts have no words; rows without an id are
    compared with nothing and stay whole; rows that share an id are one document
    of several texts, none of which repeats another; an empty table gives an
    empty result. Other columns are not looked at.
    """
    if not 0 < seed <= window:
        raise ValueError("a seed must fit into the window")
    columns = [docs[f"`{doc_id}`"].cast("long").alias("doc_id"), docs[f"`{text}`"].cast("binary").alias("text")]
    body = docs.select(*columns).withColumn("row", F.xxhash64("text"))
    repeats = find_repeats(body, window, seed).select(F.col("doc_id").alias("later_id"), F.col("row").alias("later_row"), "repeats")
    packed = body.select("doc_id", "row", pack("text").alias("packed"))
    marked = packed.join(repeats, (F.col("doc_id") == F.col("later_id")) & (F.col("row") == F.col("later_row")), "left")
    cut = marked.select("doc_id", _cut_udf(window)("packed", "repeats").alias("cut"))
    return cut.select("doc_id", "cut.n_words", "cut.n_removed", "cut.kept", "cut.spans")
