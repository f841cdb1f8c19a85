"""Compression of vectors to codes of their parts, with nearest entries found in vantage-point trees."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rastra.llm.common import output, spread_join
from rastra.storage import discard, settle

#: Components are scaled by this and rounded down.
SCALE = 4096
#: Scaled components must be smaller than this in size, so that no squared distance or error leaves 64 bits.
LIMIT = 1 << 27
#: Relative slack of a floating-point root or sum, several times what rounding can take.
_SLACK = 1e-14


def _squares(points: np.ndarray, one: np.ndarray) -> np.ndarray:
    apart = points - one
    return (apart * apart).sum(axis=1)


def _below(x: np.ndarray) -> np.ndarray:
    return x * (1 - _SLACK)


def _above(x: np.ndarray) -> np.ndarray:
    return x * (1 + _SLACK)


@dataclass
class _Node:
    """An entry as vantage point, and on either side the entries' distances from it: not less than ``low``, not more than ``high``."""

    entry: int
    sides: list[tuple[float, float, _Node]]


class VantageTree:
    """Exact nearest entries of integer points by squared Euclidean distance, ties to the lower index.

    Branches are passed over only if the triangle inequality, with every root
    and bound rounded to the safe side, puts all of their entries further away than the
    best so far; a bound that equals it is visited, as the tie may go to a lower
    index. Whether an entry is nearer is decided on integers.
    """

    def __init__(self, entries: np.ndarray):
        self.entries = np.asarray(entries, dtype=np.int64)
        self.root = self._grow(list(range(len(self.entries)))) if len(self.entries) else None

    def _grow(self, members: list[int]) -> _Node:
        entry, rest = members[0], np.array(members[1:], dtype=np.int64)
        if not len(rest):
            return _Node(entry, [])
        away = _squares(self.entries[rest], self.entries[entry])
        order = np.argsort(away, kind="stable")
        half = (len(rest) + 1) // 2
        sides = []
        for part in (order[:half], order[half:]):
            if len(part):
                near, far = np.sqrt(away[part[0]].astype(np.float64)), np.sqrt(away[part[-1]].astype(np.float64))
                sides.append((float(_below(near)), float(_above(far)), self._grow(rest[part].tolist())))
        return _Node(entry, sides)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and squared distance of each point."""
        best = np.full(len(points), np.iinfo(np.int64).max)
        index = np.full(len(points), len(self.entries), dtype=np.int64)
        if self.root is not None and len(points):
            self._visit(self.root, points, np.arange(len(points)), best, index)
        return index, best

    def _visit(self, node: _Node, points: np.ndarray, rows: np.ndarray, best: np.ndarray, index: np.ndarray) -> None:
        away = _squares(points[rows], self.entries[node.entry])
        nearer = (away < best[rows]) | ((away == best[rows]) & (node.entry < index[rows]))
        best[rows[nearer]], index[rows[nearer]] = away[nearer], node.entry
        if not node.sides:
            return
        root = np.sqrt(away.astype(np.float64))
        least, most = _below(root), _above(root)
        # the side that a point lies in comes first, so that the other one is more often passed over
        split = node.sides[0][1]
        inner = root <= split
        for own in (inner, ~inner):
            if not own.any():
                continue
            order = node.sides if own is inner else node.sides[::-1]
            for low, high, below in order:
                bound = np.maximum(np.maximum(_below(least[own] - high), _below(low - most[own])), 0.0)
                may = bound <= _above(np.sqrt(best[rows[own]].astype(np.float64)))
                if may.any():
                    self._visit(below, points, rows[own][may], best, index)


def as_integers(column: pa.Array) -> np.ndarray:
    """The components of all vectors, scaled and rounded down."""
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * SCALE)
    if len(flat) and np.abs(flat).max() >= LIMIT:
        raise ValueError(f"components must be smaller than {LIMIT // SCALE} in size")
    return flat.astype(np.int64)


def _rows(batch: pa.RecordBatch, books: list[np.ndarray]) -> np.ndarray:
    width = sum(b.shape[1] for b in books)
    if batch.num_rows and set(batch["parts"].value_lengths().to_pylist()) != {width}:
        raise ValueError("vectors must be of one length")
    return batch["parts"].flatten().to_numpy().reshape(-1, width)


_SUMS = "part int, entry int, n bigint, sums array<bigint>"
_SUMS_ARROW = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])
_CODES = pa.schema([("nth", pa.int64()), ("vec_id", pa.int64()), ("label", pa.string()), ("code", pa.string()), ("error", pa.int64())])


def _trees(books: list[np.ndarray]) -> list[VantageTree]:
    return [VantageTree(b) for b in books]


def _sums(books: list[np.ndarray]):
    """Sums and counts of the parts nearest to each entry: one row an entry and task at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = _trees(books)
        sums = [np.zeros(b.shape, dtype=np.int64) for b in books]
        counts = [np.zeros(len(b), dtype=np.int64) for b in books]
        for batch in batches:
            rows = _rows(batch, books)
            for p, part in enumerate(np.split(rows, len(books), axis=1)):
                index, _ = trees[p].nearest(part)
                np.add.at(sums[p], index, part)
                counts[p] += np.bincount(index, minlength=len(counts[p]))
        found = [(p, e) for p in range(len(books)) for e in np.flatnonzero(counts[p]).tolist()]
        if found:
            yield output({"part": [p for p, _ in found], "entry": [e for _, e in found], "n": [int(counts[p][e]) for p, e in found], "sums": [sums[p][e].tolist() for p, e in found]}, _SUMS_ARROW)

    return run


def _assign(books: list[np.ndarray]):
    """Codes and errors of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = _trees(books)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _rows(batch, books)
            error, digits = np.zeros(len(rows), dtype=np.int64), []
            for p, part in enumerate(np.split(rows, len(books), axis=1)):
                index, away = trees[p].nearest(part)
                error += away
                digits.append(index.astype(np.uint8))
            codes = [bytes(r).hex() for r in np.stack(digits, axis=1)]
            yield output({"nth": batch["nth"], "vec_id": batch["vec_id"], "label": batch["label"], "code": codes, "error": pa.array(error)}, _CODES)

    return run


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = batch["embedding"]
        ends = np.concatenate([[0], np.cumsum(vectors.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int32)
        parts = pa.ListArray.from_arrays(pa.array(ends), pa.array(as_integers(vectors)))
        yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["label"], parts], names=["vec_id", "label", "parts"])


def kept_vectors(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """``vec_id, label, parts``: scaled components of the vectors that have some, all of them finite; labels as text that tells null from any label."""
    x = F.col("embedding")
    good = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    plain = df.select(
        df[f"`{vec_id}`"].cast("long").alias("vec_id"),
        F.coalesce(F.concat(F.lit("="), df[f"`{label}`"].cast("string")), F.lit("")).alias("label"),
        df[f"`{embedding}`"].cast("array<double>").alias("embedding"),
    )
    return plain.where(F.coalesce(good, F.lit(False))).mapInArrow(_whole, "vec_id bigint, label string, parts array<bigint>")


def first_books(kept: DataFrame, n_parts: int, n_entries: int) -> list[np.ndarray]:
    """The parts of the vectors with the ``n_entries`` smallest ids."""
    first = kept.where("vec_id IS NOT NULL").orderBy("vec_id", "parts").limit(n_entries).collect()
    if not first:
        return []
    if len({len(r["parts"]) for r in first}) > 1:
        raise ValueError("vectors must be of one length")
    rows = np.array([r["parts"] for r in first], dtype=np.int64)
    if rows.shape[1] % n_parts:
        raise ValueError(f"vectors must have a multiple of {n_parts} components")
    return np.split(rows, n_parts, axis=1)


def refine_books(kept: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """Each entry's parts' mean, rounded down; entries without parts stay. The driver gets a row an entry."""
    found = kept.select("parts").mapInArrow(_sums(books), _SUMS)
    width = books[0].shape[1]
    summed = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(i))) for i in range(width)]).alias("sums"))
    renewed = [b.copy() for b in books]
    for r in summed.collect():
        renewed[r["part"]][r["entry"]] = [s // r["n"] for s in r["sums"]]
    return renewed


def books_sha256(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def compress_vectors(
    df: DataFrame, n_parts: int = 8, n_entries: int = 16, rounds: int = 6, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label"
) -> tuple[DataFrame, list[np.ndarray]]:
    """Codes of vectors under codebooks of their parts, and the codebooks.

    Components are scaled by 4096 and rounded down; a vector is cut into
    ``n_parts`` equal parts, each with a codebook that starts as that part of the
    ``n_entries`` smallest ids (fewer if there are fewer; up to 256) and is
    refined in ``rounds`` of nearest entries and means rounded down, all in
    whole numbers. A round is one pass over the vectors that sums parts in each
    task; the driver gets one row an entry. Rows: ``vec_id, code`` (two hex
    digits a part), ``error`` (squared distances of all parts), ``label_error``
    (errors of all vectors of the label).

    Null or empty vectors and those with a null, infinite or undefined
    component are dropped. Vectors without an id get codes, but no entry starts from
    one; if none has an id the result is empty. Rows with one id are each a
    vector; among them the smaller vector starts an entry first. Null labels are a label
    of their own; errors of a label are summed in 64 bits. Components of 32768 and
    more in size, and lengths that differ or are no multiple of ``n_parts``, are an error.
    """
    if not 0 < n_entries <= 256:
        raise ValueError("n_entries must lie in 1..256")
    kept = settle(kept_vectors(df, vec_id, embedding, label), "vectors", compression="zstd")
    books = first_books(kept, n_parts, n_entries)
    if not books:
        return df.sparkSession.createDataFrame([], "vec_id bigint, code string, error bigint, label_error bigint"), books
    for _ in range(rounds):
        books = refine_books(kept, books)
    numbered = kept.withColumn("nth", F.xxhash64("vec_id", "parts"))
    coded = settle(numbered.mapInArrow(_assign(books), "nth bigint, vec_id bigint, label string, code string, error bigint"), "vector_codes", compression="zstd")
    discard(kept)
    labels = settle(coded.groupBy("label").agg(F.count("*").alias("n"), F.sum("error").alias("label_error")), "vector_labels")
    rated = spread_join(coded, labels, ["label"], "n", ["nth"])
    return rated.select("vec_id", "code", "error", "label_error"), books
